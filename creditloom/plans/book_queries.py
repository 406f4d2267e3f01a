"""Registered queries over the application book: scans, splits, checks, derived ratios, joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.config import SEED
from creditloom.functions.expr import age_band, mask_thin_file, observed_outcome
from creditloom.operators import derive, quality, split
from creditloom.plans.common import r, tidy
from creditloom.sources import io, views
from creditloom.sources.staging import shared_folder
from creditloom.sources.views import APPS_SQL, DOCS_SQL, OOT_MONTH, OUTCOMES_SQL, SPLIT_SQL

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@query(
    APPS_SQL
    + f"""SELECT id, application_date, application_month, approved, y, total_price, n_lines,
          {r('mean_discount')} AS mean_discount, {r('mean_quantity')} AS mean_quantity, acctbal,
          days_since_prev, segment, priority FROM apps"""
)
def book_scan(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(views.apps(spark, sf).drop("customer"))


@query(APPS_SQL + f"SELECT id, {SPLIT_SQL} AS split FROM apps WHERE approved = 1")
def time_split(spark: SparkSession, sf: str) -> DataFrame:
    book = views.apps(spark, sf, lines=False, customer=False, gap=False)
    return views.with_split(book).select("id", "split")


@query(
    APPS_SQL
    + f"""SELECT {SPLIT_SQL} AS split, count(*) AS rows, count(y) AS with_outcome,
          {r('avg(y)', 4)} AS bad_rate, CAST(min(application_date) AS DATE) AS date_from,
          CAST(max(application_date) AS DATE) AS date_to
          FROM apps WHERE approved = 1 GROUP BY ALL"""
)
def split_describe(spark: SparkSession, sf: str) -> DataFrame:
    book = views.with_split(views.apps(spark, sf, customer=False, gap=False))
    return tidy(split.describe_splits(book, y="y", date="application_date"), 4)


@query(
    APPS_SQL
    + ", "
    + OUTCOMES_SQL
    + f"""SELECT count(*) AS rows, {r('avg(approved)')} AS approval_rate,
          {r('avg(true_default_flag) FILTER (approved = 1)')} AS bad_rate_approved,
          {r('avg(true_default_flag) FILTER (approved = 0)')} AS bad_rate_rejected,
          {r('avg(true_default_flag)')} AS bad_rate_all,
          {r('avg(CASE WHEN coalesce(days_since_prev, 0) < 90 THEN 1 ELSE 0 END)')} AS thin_file_share,
          {r(f'avg(CASE WHEN application_month >= {OOT_MONTH} THEN 1 ELSE 0 END)')} AS oot_share,
          count(*) FILTER (application_month >= {OOT_MONTH}) AS oot_rows
          FROM apps JOIN outcomes USING (id)"""
)
def book_summary(spark: SparkSession, sf: str) -> DataFrame:
    book = views.apps(spark, sf, lines=False, customer=False)
    known = book.join(views.outcomes(spark, sf), "id")
    return tidy(
        split.book_summary(
            known,
            outcome="true_default_flag",
            thin_file=F.coalesce("days_since_prev", F.lit(0.0)) < 90,
            oot_start_month=OOT_MONTH,
        )
    )


_RATES = ("total_price", "n_lines", "mean_discount", "mean_quantity", "acctbal", "days_since_prev", "y")


@query(
    APPS_SQL
    + "SELECT feature, missing_rate FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)')} AS missing_rate FROM apps"
        for c in _RATES
    )
    + ") WHERE missing_rate > 0"
)
def missing_rate(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(quality.missing_rates(views.apps(spark, sf), _RATES))


@query(
    APPS_SQL
    + f"""SELECT count(*) AS rows, count(*) FILTER (y IS NULL) AS without_outcome,
          CAST({' + '.join(f"count(*) FILTER (isinf(CAST({c} AS DOUBLE)))" for c in _RATES)} AS BIGINT)
            AS infinite_values FROM apps"""
)
def quality_checks(spark: SparkSession, sf: str) -> DataFrame:
    book = quality.require_columns(views.apps(spark, sf), _RATES)
    return quality.quality_counts(book, _RATES, "y")


def _clip_sql(x: str, lo: str, hi: str) -> str:
    return f"CASE WHEN ({x}) IS NOT NULL THEN least(greatest({x}, {lo}), {hi}) END"


def _rint(x: str) -> str:
    return f"(round_even(({x}) * 10000.0::DOUBLE, 0) / 10000.0::DOUBLE + 0.0::DOUBLE)"


_D = {
    "buffer_days": _rint(_clip_sql("acctbal / (total_price / 30.0::DOUBLE + 1.0::DOUBLE)", "0.0::DOUBLE", "120.0::DOUBLE")),
    "liquidity_stress": _rint("n_lines / 30.0::DOUBLE * mean_discount"),
    "betting_to_savings": _rint(
        _clip_sql("mean_discount / (mean_quantity / 50.0::DOUBLE + 0.02::DOUBLE)", "0.0::DOUBLE", "50.0::DOUBLE")
    ),
    "credit_hunger": _rint("n_lines * (1.0::DOUBLE + mean_discount) / (1.0::DOUBLE + days_since_prev)"),
    "obligation_discipline": _rint(
        """CASE WHEN mean_discount IS NULL AND days_since_prev IS NULL AND mean_quantity IS NULL THEN NULL ELSE
           (coalesce(mean_discount, 0.0::DOUBLE) + coalesce(days_since_prev / 1000.0::DOUBLE, 0.0::DOUBLE)
            + coalesce(mean_quantity / 50.0::DOUBLE, 0.0::DOUBLE))
           / ((mean_discount IS NOT NULL)::INT + (days_since_prev IS NOT NULL)::INT
              + (mean_quantity IS NOT NULL)::INT) END"""
    ),
    "income_stability": _rint("mean_quantity * (1.0::DOUBLE + 0.5::DOUBLE * approved)"),
    "exposure_to_capacity": _rint(
        _clip_sql(
            "(mean_discount * total_price) / ((greatest(acctbal / 10000.0::DOUBLE, 0.0::DOUBLE) + 0.02::DOUBLE)"
            " * total_price + 1.0::DOUBLE)",
            "0.0::DOUBLE",
            "200.0::DOUBLE",
        )
    ),
}


@query(APPS_SQL + "SELECT id, " + ", ".join(f"{x} AS {n}" for n, x in _D.items()) + " FROM apps")
def derived_ratios(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return views.apps(spark, sf).select(
        "id",
        derive.buffer_days(c("acctbal"), c("total_price")).alias("buffer_days"),
        derive.liquidity_stress(c("n_lines"), c("mean_discount")).alias("liquidity_stress"),
        derive.betting_to_savings(c("mean_discount"), c("mean_quantity") / 50.0).alias("betting_to_savings"),
        derive.credit_hunger(c("n_lines"), c("mean_discount"), c("days_since_prev")).alias("credit_hunger"),
        derive.obligation_discipline(
            c("mean_discount"), c("days_since_prev") / 1000.0, c("mean_quantity") / 50.0
        ).alias("obligation_discipline"),
        derive.income_stability(c("mean_quantity"), c("approved")).alias("income_stability"),
        derive.exposure_to_capacity(
            c("mean_discount"), c("acctbal") / 10000.0, c("total_price")
        ).alias("exposure_to_capacity"),
    )


@query(
    APPS_SQL
    + f"""SELECT priority, count(*) AS rows, count(m) AS with_value, {r('avg(m)')} AS mean_value FROM (
          SELECT priority, CASE WHEN mean_discount IS NOT NULL OR days_since_prev IS NOT NULL THEN
            (coalesce(mean_discount, 0) + coalesce(days_since_prev / 1000.0::DOUBLE, 0))
            / ((mean_discount IS NOT NULL)::INT + (days_since_prev IS NOT NULL)::INT) END AS m
          FROM apps) GROUP BY priority"""
)
def nan_aware_mean(spark: SparkSession, sf: str) -> DataFrame:
    m = derive.mean_present(F.col("mean_discount"), F.col("days_since_prev") / 1000.0)
    book = views.apps(spark, sf, customer=False).select("priority", m.alias("m"))
    return tidy(
        book.groupBy("priority").agg(
            F.count(F.lit(1)).alias("rows"), F.count("m").alias("with_value"), F.avg("m").alias("mean_value")
        )
    )


@query(
    """SELECT age_band, count(*) AS customers FROM (
         SELECT CASE WHEN age <= 17 THEN NULL WHEN age <= 24 THEN '18-24' WHEN age <= 34 THEN '25-34'
                     WHEN age <= 44 THEN '35-44' WHEN age <= 54 THEN '45-54' WHEN age <= 100 THEN '55+' END AS age_band
         FROM (SELECT floor((c_acctbal + 1000) / 120) + 15 AS age FROM customer)) GROUP BY age_band"""
)
def age_band_case(spark: SparkSession, sf: str) -> DataFrame:
    age = F.floor((F.col("c_acctbal") + 1000) / 120) + 15
    people = views.table(spark, sf, "customer").select(age_band(age).alias("age_band"))
    return people.groupBy("age_band").agg(F.count(F.lit(1)).alias("customers"))


@query(
    APPS_SQL
    + ", "
    + OUTCOMES_SQL
    + """SELECT id, CASE WHEN days_since_prev >= 90 THEN total_price END AS masked_price,
           CASE WHEN approved = 1 THEN CAST(true_default_flag AS DOUBLE) END AS observed
         FROM apps JOIN outcomes USING (id)"""
)
def thin_file_mask(spark: SparkSession, sf: str) -> DataFrame:
    book = views.apps(spark, sf, lines=False, customer=False)
    return book.join(views.outcomes(spark, sf), "id").select(
        "id",
        mask_thin_file(F.col("total_price"), F.col("days_since_prev")).alias("masked_price"),
        observed_outcome(F.col("true_default_flag"), F.col("approved")).alias("observed"),
    )


# ------------------------------------------------------------------------- joins


@query(
    APPS_SQL
    + ", "
    + OUTCOMES_SQL
    + """SELECT id, approved, y, true_default_flag FROM apps LEFT JOIN outcomes USING (id)"""
)
def oracle_join(spark: SparkSession, sf: str) -> DataFrame:
    book = views.apps(spark, sf, customer=False, gap=False).select("id", "approved", "y")
    return quality.attach_oracle(book, views.outcomes(spark, sf), "id", ["true_default_flag"])


@query(
    DOCS_SQL
    + """SELECT d.id, d.n_chars, l.quality, l.toxic FROM docs d JOIN labels l ON l.doc_id = d.id"""
)
def one_to_one_join(spark: SparkSession, sf: str) -> DataFrame:
    texts = views.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    labels = views.table(spark, sf, "labels").withColumnRenamed("doc_id", "id")
    return quality.join_one_to_one(texts, labels, "id")


@query(
    DOCS_SQL
    + f""", sides AS (
          SELECT source AS level, count(*) FILTER (approved = 1) AS labelled,
                 count(*) FILTER (approved = 0) AS unlabelled FROM docs GROUP BY source)
        SELECT level, {r('labelled / (SELECT sum(labelled) FROM sides)')} AS labelled_share,
               {r('unlabelled / (SELECT sum(unlabelled) FROM sides)')} AS unlabelled_share FROM sides"""
)
def level_align(spark: SparkSession, sf: str) -> DataFrame:
    """Level shares of two samples on the union of their levels: both counted in one pass."""
    book = views.docs(spark, sf).select("approved", F.col("source").alias("level"))
    counts = book.groupBy("level").agg(
        F.count_if(F.col("approved") == 1).alias("labelled"), F.count_if(F.col("approved") == 0).alias("unlabelled")
    )
    whole = Window.partitionBy(F.lit(0))  # one row per level
    return tidy(counts.select("level", *[(F.col(c) / F.sum(c).over(whole)).alias(f"{c}_share") for c in ("labelled", "unlabelled")]))


@query(
    """WITH train AS (SELECT DISTINCT lang FROM documents d JOIN labels l ON l.doc_id = d.doc_id
                      WHERE l.quality = 1 AND l.toxic = 0)
       SELECT d.doc_id AS id, t.lang AS lang FROM documents d LEFT JOIN train t ON t.lang = d.lang"""
)
def category_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Levels unseen in the train part become null."""
    book = views.docs(spark, sf).select(
        "id", "lang", F.when(F.col("y") == 0, "train").otherwise("other").alias("split")
    )
    return io.align_levels(book, ["lang"]).select("id", "lang")


@query("""SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def anti_join(spark: SparkSession, sf: str) -> DataFrame:
    texts = views.table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    labels = views.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return texts.join(labels, "id", "left_anti")


@query(
    """(SELECT DISTINCT l_orderkey AS "order" FROM lineitem)
       EXCEPT (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"""
)
def set_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of which nothing was returned."""
    items = views.table(spark, sf, "lineitem")
    sold = items.select(F.col("l_orderkey").alias("order"))
    return sold.subtract(items.where("l_returnflag = 'R'").select("l_orderkey"))


@query(
    """SELECT lang AS level FROM documents d JOIN labels l ON l.doc_id = d.doc_id
       UNION SELECT source AS level FROM documents"""
)
def set_union(spark: SparkSession, sf: str) -> DataFrame:
    book = views.docs(spark, sf)
    labelled = book.where("approved = 1").select(F.col("lang").alias("level"))
    return labelled.union(book.select("source")).distinct()


@query(
    APPS_SQL
    + f"""SELECT id, split, y, total_price FROM (SELECT *, {SPLIT_SQL} AS split FROM apps WHERE approved = 1) WHERE split = 'valid'"""
)
def view_per_split(spark: SparkSession, sf: str) -> DataFrame:
    """A modelling view written by split, and one split of it read back."""
    path = f"{shared_folder(spark)}/creditloom/view-{uuid.uuid4().hex}"
    io.write_view(views.with_split(views.apps(spark, sf, gap=False)).select("id", "split", "y", "total_price"), path)
    return io.read_view(spark, path, "valid").select("id", "split", "y", "total_price")


@query(
    APPS_SQL
    + f"""SELECT id, CASE WHEN application_month >= {OOT_MONTH} THEN 'oot'
            WHEN ('0x' || substr(md5('{SEED}:' || id), 1, 12))::BIGINT % 10000 < 2000 THEN 'valid' ELSE 'train' END AS split FROM apps WHERE approved = 1"""
)
def seeded_split(spark: SparkSession, sf: str) -> DataFrame:
    """The time split with a seeded fifth of the earlier months for validation."""
    book = views.apps(spark, sf, lines=False, customer=False, gap=False)
    return split.time_split(book, oot_start_month=OOT_MONTH, key="id", validation_fraction=0.2).select("id", "split")
