"""Role-mapped views over the base tables: an application book, labelled texts, transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OOT_MONTH = 62
BAD_RETURNS = 3
APP_NUMERIC = (
    "total_price",
    "n_lines",
    "mean_discount",
    "mean_quantity",
    "acctbal",
    "days_since_prev",
)
APP_CATEGORICAL = ("segment", "priority")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def days_since_previous(
    df: DataFrame,
    key: str,
    when: str,
    order: str,
    name: str = "days_since_prev",
    extra: DataFrame | None = None,
) -> DataFrame:
    """Days since the same key's previous row in (day, order) sequence; null on the first.

    Rows of one key and day collapse before any window, so the window per key sees one row
    per calendar day however many rows the key has. ``extra`` holds columns by key; they are
    joined to the collapsed days, so a hot key is never joined row by row on the key alone.
    """
    day = F.to_date(when)
    days = df.groupBy(key, day.alias("_day")).agg(F.min(order).alias("_first"))
    past = F.lag("_day").over(Window.partitionBy(key).orderBy("_day"))
    days = days.withColumn("_past", past)
    more = []
    if extra is not None:
        days = days.join(extra, key, "left")
        more = [c for c in extra.columns if c != key]
    days = days.withColumnRenamed(key, "_key")
    joined = df.join(days, (F.col(key) == F.col("_key")) & (day == F.col("_day")), "left")
    gap = F.when(F.col(order) > F.col("_first"), 0).otherwise(F.datediff("_day", "_past"))
    return joined.select(*df.columns, *more, gap.cast("double").alias(name))


def apps(
    spark: SparkSession,
    sf_dir: str,
    *,
    lines: bool = True,
    customer: bool = True,
    gap: bool = True,
) -> DataFrame:
    """One row per order, in the shape of an application book.

    Parts a query does not read can be switched off; their joins then do not run.
    """
    orders = table(spark, sf_dir, "orders")
    people = None
    if customer:
        people = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"),
            F.col("c_acctbal").alias("acctbal"),
            F.col("c_mktsegment").alias("segment"),
        )
    if gap:
        orders = days_since_previous(
            orders, "o_custkey", "o_orderdate", "o_orderkey", extra=people
        )
    elif customer:
        orders = orders.join(people, "o_custkey", "left")
    if lines:
        items = (
            table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(
                F.count(F.lit(1)).alias("n_lines"),
                F.round(F.avg("l_discount"), 6).alias("mean_discount"),
                F.round(F.avg("l_quantity"), 6).alias("mean_quantity"),
                F.count_if(F.col("l_returnflag") == "R").alias("_returned"),
            )
        )
        orders = orders.join(items, "o_orderkey", "left")
    approved = F.when(F.col("o_orderstatus") != "P", 1).otherwise(0)
    month = (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1
    extra = []
    if lines:
        bad = (F.coalesce("_returned", F.lit(0)) >= BAD_RETURNS).cast("double")
        extra += [F.when(approved == 1, bad).alias("y"), "n_lines", "mean_discount", "mean_quantity"]
    if customer:
        extra += ["acctbal", "segment"]
    if gap:
        extra += ["days_since_prev"]
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderdate").alias("application_date"),
        month.cast("int").alias("application_month"),
        approved.alias("approved"),
        F.col("o_totalprice").alias("total_price"),
        F.col("o_orderpriority").alias("priority"),
        *extra,
    )


APPS_SQL = """
WITH items AS (
  SELECT l_orderkey, count(*) AS n_lines, round(avg(l_discount), 6) AS mean_discount,
         round(avg(l_quantity), 6) AS mean_quantity,
         count(*) FILTER (l_returnflag = 'R') AS returned
  FROM lineitem GROUP BY l_orderkey
), apps AS (
  SELECT o_orderkey AS id, o_custkey AS customer, o_orderdate AS application_date,
         CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS INTEGER) AS application_month,
         CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END AS approved,
         o_totalprice AS total_price, o_orderpriority AS priority,
         CASE WHEN o_orderstatus <> 'P'
              THEN CASE WHEN coalesce(returned, 0) >= 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS y,
         n_lines, mean_discount, mean_quantity,
         c_acctbal AS acctbal, c_mktsegment AS segment,
         CAST(date_diff('day', lag(o_orderdate) OVER
              (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate) AS DOUBLE)
              AS days_since_prev
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey
              LEFT JOIN items ON l_orderkey = o_orderkey
)
"""


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as applications: labelled means approved, toxic or low quality means bad."""
    labels = table(spark, sf_dir, "labels")
    texts = table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", F.size(F.split(F.trim("text"), r"\s+")).alias("n_words"), "lang", "source"
    )
    bad = F.when(
        F.col("quality").isNotNull(), F.greatest("toxic", 1 - F.col("quality")).cast("double")
    )
    return texts.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("quality").isNotNull(), 1).otherwise(0).alias("approved"),
        bad.alias("y"),
        "n_chars",
        "n_words",
        "lang",
        "source",
    )


DOCS_SQL = """
WITH docs AS (
  SELECT d.doc_id AS id, CASE WHEN quality IS NOT NULL THEN 1 ELSE 0 END AS approved,
         CASE WHEN quality IS NOT NULL
              THEN CAST(greatest(toxic, 1 - quality) AS DOUBLE) END AS y,
         n_chars, lang, source
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)
"""


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as wallet transactions."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        "ts",
        F.col("event_type").alias("type"),
        F.col("value").alias("amount"),
        F.get_json_object("props", "$.k").alias("party"),
    )


TXN_SQL = """
WITH txn AS (
  SELECT user_id, ts, event_type AS type, value AS amount,
         json_extract_string(props, '$.k') AS party
  FROM events
)
"""


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every order turned out to be, approved or not: for evaluation only."""
    returned = (
        table(spark, sf_dir, "lineitem")
        .where("l_returnflag = 'R'")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.count(F.lit(1)).alias("_returned"))
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    bad = (F.coalesce("_returned", F.lit(0)) >= BAD_RETURNS).cast("int")
    return orders.join(returned, "id", "left").select("id", bad.alias("true_default_flag"))


OUTCOMES_SQL = """
outcomes AS (
  SELECT o_orderkey AS id,
         CASE WHEN coalesce(r.returned, 0) >= 3 THEN 1 ELSE 0 END AS true_default_flag
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS returned FROM lineitem
                         WHERE l_returnflag = 'R' GROUP BY l_orderkey) r ON r.l_orderkey = o_orderkey
)
"""


def with_split(book: DataFrame, approved_only: bool = True) -> DataFrame:
    """The time split of the apps view, with a key rule that SQL engines share."""
    from creditloom.operators.split import time_split

    return time_split(
        book,
        oot_start_month=OOT_MONTH,
        approved_only=approved_only,
        key="id",
        valid_when=F.col("id") % 5 == 0,
    )


SPLIT_SQL = f"""CASE WHEN application_month >= {OOT_MONTH} THEN 'oot'
                     WHEN id % 5 = 0 THEN 'valid' ELSE 'train' END"""


def scored(spark: SparkSession, sf_dir: str, approved_only: bool = True) -> DataFrame:
    """The apps view with a fixed-weight probability, to six places, and its split."""
    z = (
        F.lit(-4.0)
        + 0.55 * F.coalesce("n_lines", F.lit(0))
        + 6.0 * F.coalesce("mean_discount", F.lit(0.05))
        - 0.00002 * F.col("acctbal")
    )
    book = with_split(apps(spark, sf_dir, gap=False), approved_only)
    return book.withColumn("p", F.round(1.0 / (1.0 + F.exp(-z)), 6))


SCORED_SQL = f"""
, scored AS (
  SELECT *, {SPLIT_SQL} AS split,
         round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(-4.0::DOUBLE + 0.55::DOUBLE * coalesce(n_lines, 0)
               + 6.0::DOUBLE * coalesce(mean_discount, 0.05::DOUBLE)
               - 0.00002::DOUBLE * acctbal))), 6) AS p
  FROM apps
)
"""
