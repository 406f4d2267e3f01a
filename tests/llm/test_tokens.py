"""Token counting and byte-level BPE against the libraries themselves."""

import hashlib

import numpy as np
import public_tokenizers as P
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from creditloom.llm import byte_bpe, token_counts

MODEL, RANKS = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.tiktoken")
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)
TIERS = token_counts._counters(MODEL, {}, 1000)
V = byte_bpe.load(RANKS, P.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=V.ranks, special_tokens={})
ODD = [
    None, "", " ", "  ", "\n", " \n ", "a", "a ", " a", "a  b   c", "a\n b\n\n  c", "\r\nx", "\tq", "<s> </s> <unk>",
    "▁a▁▁b", "ﬁ é é 日本語 🎉🎉", "\x00 \x00", "don't we'll I'M", "x" * 3000, " " * 700, "9" * 500 + " ." * 300,
    "<|endoftext|>",
]
TEXT = st.text(st.sampled_from(list("ab th\n é'9.▁ \t日<>s|")) | st.characters(codec="utf-8"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_counts_are_the_librarys(text):
    assert token_counts.count_tokens(text, *TIERS) == len(SP.encode(text))


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_ids_are_the_librarys(text):
    packed = byte_bpe.encode(V, text)
    assert np.frombuffer(packed, "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert byte_bpe.decode(V, packed) == text.encode()


@settings(max_examples=200, deadline=None)
@given(TEXT, st.data(), st.text("ab th\n'9 ", max_size=8))
def test_edits_equal_encoding_anew(text, data, new):
    i, j = sorted(data.draw(st.tuples(*[st.integers(0, len(text))] * 2)))
    changed, ids = byte_bpe.edit(V, text, byte_bpe.encode(V, text), i, j, new)
    assert changed == text[:i] + new + text[j:]
    assert ids == byte_bpe.encode(V, changed)


@settings(max_examples=200, deadline=None)
@given(st.text("abthe ing", min_size=1, max_size=30), st.integers(0, 30))
def test_appends_equal_one_go(word, at):
    whole = byte_bpe.PrefixTable(V, word.encode())
    grown = byte_bpe.PrefixTable(V, word[:at].encode())
    grown.append(word[at:].encode())
    assert grown.last == whole.last and grown.ids() == whole.ids()
    grown.cut(at)
    assert grown.last == byte_bpe.PrefixTable(V, word[:at].encode()).last


def test_operators_on_odd_rows(spark):
    texts = [*ODD, "same", "same", "word " * 6000]
    rows = [(i if i else None, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    counts = {r.doc_id: r for r in token_counts.token_counts(docs, MODEL).collect()}
    coded = {r.doc_id: r for r in byte_bpe.byte_bpe(docs, RANKS, P.PATTERN).collect()}
    for i, t in enumerate(texts):
        t, i = t or "", i or None
        assert counts[i].n_tokens == len(SP.encode(t)) and counts[i].n_bytes == len(t.encode())
        assert counts[i].over_limit == (counts[i].n_tokens > 4096)
        ids = LIBRARY.encode_ordinary(t)
        assert coded[i].ids == ids and coded[i].n_tokens == len(ids)
        assert coded[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert coded[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert token_counts.token_counts(docs.limit(0), MODEL).count() == 0
    assert byte_bpe.byte_bpe(docs.limit(0), RANKS, P.PATTERN).count() == 0
