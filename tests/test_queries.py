"""Every registered query against its SQL on the smallest tables, and some on skewed ones."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def connect(folder):
    db = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return db


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def text(v):
    if v is None:
        return "NULL"
    return repr(float(v)) if isinstance(v, float) else str(v)


def rows(found, names, columns):
    order = [names.index(c) for c in columns]
    return sorted(tuple(text(r[i]) for i in order) for r in found)


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, db, folder, name):
    df = entry_point.queries()[name](spark, folder)
    columns = sorted(df.columns)
    result = db.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == theirs
    mine = rows([tuple(r) for r in df.select(*columns).collect()], columns, columns)
    assert mine == rows(result.fetchall(), names, columns)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    compare(spark, db, SF, name)


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


# ------------------------------------------------------------------ one hot key


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The small tables again, with one customer and one user holding most of the rows."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    rng = np.random.default_rng(1)
    source = connect(SF)
    orders = source.execute("SELECT * FROM orders").df()
    orders.loc[rng.random(len(orders)) < 0.6, "o_custkey"] = int(orders["o_custkey"].iloc[0])
    events = source.execute("SELECT * FROM events").df()
    events.loc[rng.random(len(events)) < 0.6, "user_id"] = int(events["user_id"].iloc[0])
    written = duckdb.connect()
    for name, pdf in (("orders", orders), ("events", events)):
        written.register("pdf", pdf)
        written.execute(f"COPY pdf TO '{folder}/{name}.parquet' (FORMAT parquet)")
        written.unregister("pdf")
    for t in ("customer", "lineitem", "documents", "labels"):
        source.execute(f"COPY {t} TO '{folder}/{t}.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize(
    "name",
    ["book_scan", "mart_gap_regularity", "mart_daily", "mart_set_stability", "mart_hhi", "prebin_edges",
     "rank_ordering", "evaluation", "csi"],
)
def test_hot_keys_change_nothing(spark, skewed, both_paths, name):
    compare(spark, connect(skewed), skewed, name)


def test_pandas_is_not_in_the_row_path(spark):
    """Scoring and transforming stay on the JVM."""
    for name in ("woe_transform", "scorecard_score", "derived_ratios", "score_scale"):
        plan = entry_point.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan


def test_adaptive_skew_handling_covers_the_customer_join(spark, skewed):
    """The one row-level join on a raw key is split where that key is hot."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        from creditloom.sources import views

        orders = views.table(spark, skewed, "orders").repartition(6)
        people = views.table(spark, skewed, "customer").withColumnRenamed("c_custkey", "o_custkey")
        joined = orders.join(people, "o_custkey", "left")
        assert joined.count() == orders.count()
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_weight_correlations_cover_every_feature_and_row(spark, db):
    from creditloom.sources.views import APP_CATEGORICAL, APP_NUMERIC, APPS_SQL

    names = {*APP_NUMERIC, *APP_CATEGORICAL}
    got = {(x.feature_a, x.feature_b): x.r for x in entry_point.queries()["woe_corr_matrix"](spark, SF).collect()}
    assert set(got) == {(a, b) for a in names for b in names} and all(got[a, a] == 1 for a in names)
    dropped = db.execute(APPS_SQL + " SELECT count(*) FROM apps WHERE days_since_prev IS NULL OR n_lines IS NULL").fetchone()
    assert dropped[0] > 0  # rows that complete cases would leave out
