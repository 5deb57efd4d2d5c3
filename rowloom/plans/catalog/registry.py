"""Registration of queries with their SQL, and the roles the tables play."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions import expr as E
from rowloom.operators.folds import group_fold, with_folds
from rowloom.operators.joins import skew_join

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the statement whose result it must equal."""

    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def r6(c) -> F.Column:
    return F.round(E.col(c), 6)


# Children of a customer: one decision per order. t is days before the newest order. Amounts
# are scaled by an odd figure, so that no value sits on a rounding edge.
def decisions(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    newest = table(spark, d, "orders").select(F.max("o_orderdate")).scalar()
    return o.select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("loan"),
        F.datediff("o_orderdate", newest).alias("t"),
        (F.col("o_totalprice") / 991.07).alias("amount"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


DECISIONS = """
decisions AS (
  SELECT o_custkey AS id, o_orderkey AS loan,
         date_diff('day', (SELECT max(o_orderdate) FROM orders), o_orderdate) AS t,
         o_totalprice / 991.07::DOUBLE AS amount, nullif(o_orderstatus, 'P') AS status, o_orderpriority AS priority
  FROM orders)"""


# Instalments: line items under their order (the loan) and its customer.
def instalments(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"
    )
    newest = table(spark, d, "lineitem").select(F.max("l_shipdate")).scalar()
    late = F.datediff("l_shipdate", "o_orderdate")
    joined = skew_join(li, orders, ["l_orderkey"], "inner")
    return joined.select(
        F.col("o_custkey").alias("id"),
        F.col("l_orderkey").alias("loan"),
        F.datediff("l_shipdate", newest).alias("t"),
        E.null_if("l_linenumber", 7).alias("number"),
        (F.col("l_extendedprice") / 991.07).alias("due"),
        (F.col("l_extendedprice") / 991.07 * (1 - F.col("l_discount"))).alias("paid"),
        E.clip_low(late - 30, 0).alias("dpd"),
        E.clip_low(30 - late, 0).alias("dbd"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_returnflag").alias("status"),
        F.col("l_suppkey").alias("version"),
    )


INSTALMENTS = """
instalments AS (
  SELECT o_custkey AS id, l_orderkey AS loan,
         date_diff('day', (SELECT max(l_shipdate) FROM lineitem), l_shipdate) AS t,
         nullif(l_linenumber, 7) AS number, l_extendedprice / 991.07::DOUBLE AS due,
         l_extendedprice / 991.07::DOUBLE * (1 - l_discount) AS paid,
         greatest(date_diff('day', o_orderdate, l_shipdate) - 30, 0) AS dpd,
         greatest(30 - date_diff('day', o_orderdate, l_shipdate), 0) AS dbd,
         l_quantity AS quantity, l_discount AS discount, l_returnflag AS status, l_suppkey AS version
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


# Monthly balance rows: events per user, days before the newest event.
def balances(spark: SparkSession, d: str) -> DataFrame:
    newest = table(spark, d, "events").select(F.max("ts")).scalar()
    return table(spark, d, "events").select(
        F.col("user_id").alias("id"),
        F.col("event_id").alias("row"),
        F.datediff("ts", newest).alias("t"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.col("event_type").alias("status"),
    )


BALANCES = """
balances AS (
  SELECT user_id AS id, event_id AS row,
         date_diff('day', (SELECT max(ts) FROM events)::DATE, ts::DATE) AS t,
         CASE WHEN event_type <> 'error' THEN value END AS value, event_type AS status
  FROM events)"""


# Labelled and unlabelled rows with a few numeric and category columns.
def applicants(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    labels = table(spark, d, "labels").select("doc_id", "quality", "toxic")
    text = F.col("text")
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    vowels = F.length(text) - F.length(F.replace(text, F.lit("e"), F.lit("")))
    derived = docs.select(
        F.col("doc_id").alias("id"),
        F.nullif("lang", F.lit("de")).alias("lang"),
        "source",
        F.col("n_chars").cast("double").alias("chars"),
        spaces.cast("double").alias("spaces"),
        E.null_if(lines, 0).cast("double").alias("lines"),
        E.ratio(vowels, F.length(text)).alias("e_share"),
    )
    return derived.join(labels.withColumnRenamed("doc_id", "id"), "id", "left").withColumnRenamed("quality", "target")


APPLICANTS = """
applicants AS (
  SELECT d.doc_id AS id, nullif(lang, 'de') AS lang, source, n_chars::DOUBLE AS chars,
         (length(text) - length(replace(text, ' ', '')))::DOUBLE AS spaces,
         nullif(length(text) - length(replace(text, chr(10), '')), 0)::DOUBLE AS lines,
         (length(text) - length(replace(text, 'e', ''))) / nullif(length(text), 0)::DOUBLE AS e_share,
         toxic, quality AS target
  FROM documents d LEFT JOIN labels USING (doc_id))"""


def folded(spark: SparkSession, d: str, k: int = 5, seed: int = 42) -> DataFrame:
    return with_folds(applicants(spark, d), "id", "target", k, seed)


def folds_sql(k: int = 5, seed: int = 42) -> str:
    return f"""
folds AS (
  SELECT id, ((row_number() OVER (PARTITION BY target ORDER BY md5(concat(id, '-{seed}')), id) - 1) % {k})::INT AS fold
  FROM applicants WHERE target IS NOT NULL),
folded AS (SELECT a.*, fold FROM applicants a LEFT JOIN folds USING (id))"""


FOLDED = APPLICANTS + "," + folds_sql()


# Score files: one row per order, three models; m2 has many ties.
MODELS = ["m1", "m2", "m3"]


def scores(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")

    def h(seed):
        return E.hash_fraction(E.uniform_hash("o_orderkey", seed))

    return o.select(
        F.col("o_orderkey").alias("id"),
        E.flag(F.col("o_orderstatus") == "F").alias("target"),
        group_fold("o_orderkey").alias("fold"),
        (h(1) * 0.7 + E.flag(F.col("o_orderstatus") == "F") * 0.3).alias("m1"),
        F.round(h(2) * 0.6 + E.flag(F.col("o_orderstatus") == "F") * 0.2, 1).alias("m2"),
        (F.col("o_totalprice") / 1000000).alias("m3"),
    )


def _h(seed: int) -> str:
    return f"cast('0x' || substr(md5(concat(o_orderkey, '-{seed}')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"


SCORES = f"""
scores AS (
  SELECT o_orderkey AS id, (o_orderstatus = 'F')::INT AS target, (cast('0x' || substr(md5(concat(o_orderkey, '-42')), 1, 8) AS BIGINT) % 5)::INT AS fold,
         {_h(1)} * 0.7::DOUBLE + (o_orderstatus = 'F')::INT * 0.3::DOUBLE AS m1,
         round({_h(2)} * 0.6::DOUBLE + (o_orderstatus = 'F')::INT * 0.2::DOUBLE, 1) AS m2,
         o_totalprice / 1000000 AS m3
  FROM orders)"""
