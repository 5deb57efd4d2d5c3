"""Scans, discovery of prediction files, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.functions import expr as E
from rowloom.operators import assemble
from rowloom.plans.catalog.registry import SCORES, query, r6, scores, table
from rowloom.session import scratch_path, stored
from rowloom.sources import io

_CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@query("scan_csv_lenient", "SELECT c_custkey, c_nationkey, c_acctbal, 0::BIGINT AS rows_absent FROM customer")
def scan_csv_lenient(spark, d):
    home = scratch_path(spark, "csv")
    io.write_predictions(table(spark, d, "customer"), f"{home}/customer.csv")
    there = io.scan(spark, f"{home}/customer.csv", _CUSTOMER, missing="empty")
    absent = io.scan(spark, f"{home}/absent.csv", _CUSTOMER, missing="empty")
    return there.select("c_custkey", "c_nationkey", "c_acctbal", absent.select(F.count(F.lit(1))).scalar().alias("rows_absent"))


@query("scan_strict", "SELECT o_orderkey, o_totalprice FROM orders")
def scan_strict(spark, d):
    path = f"{d}/orders.parquet"
    return io.scan(spark, path, spark.read.parquet(path).schema, columns=["o_orderkey", "o_totalprice"])


def _prediction_files(spark, d):
    """Three prediction files in two folders, one a level deeper."""
    home = scratch_path(spark, "predictions")
    s = scores(spark, d)
    places = {"m1": "submission6.csv", "m2": "sub/submission4.csv", "m3": "old/runs/submission3.csv"}
    for model, place in places.items():
        io.write_predictions(s.select(F.col("id").alias("SK_ID_CURR"), F.col(model).alias("TARGET")), f"{home}/{place}")
    return home


@query(
    "discover_predictions",
    f"""WITH {SCORES} SELECT k.key, k.file, count(*) AS n_rows FROM scores,
        (VALUES ('sub6', 'submission6.csv'), ('sub4', 'submission4.csv'), ('sub3', 'submission3.csv')) k(key, file)
        GROUP BY ALL""",
)
def discover_predictions(spark, d):
    from rowloom.plans.credit import PREDICTION_FILES

    home = _prediction_files(spark, d)
    found = io.discover(spark, [home, f"{home}/sub"], PREDICTION_FILES, "sub6")
    parts = [
        io.scan(spark, row["path"], "SK_ID_CURR BIGINT, TARGET DOUBLE").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(row["key"]).alias("key"), F.lit(row["file"]).alias("file"), "n_rows"
        )
        for row in found.collect()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@query("load_predictions_wide", f"WITH {SCORES} SELECT id AS SK_ID_CURR, round(m1, 6) AS sub6, round(m2, 6) AS sub4, round(m3, 6) AS sub3 FROM scores")
def load_predictions_wide(spark, d):
    from rowloom.plans.credit import PREDICTION_FILES

    home = _prediction_files(spark, d)
    found = io.discover(spark, [home, f"{home}/sub"], PREDICTION_FILES, "sub6").collect()
    wide = io.load_wide(spark, {r["key"]: r["path"] for r in found})
    return wide.select("SK_ID_CURR", *[r6(c).alias(c) for c in ("sub6", "sub4", "sub3")])


@query("write_predictions", f"WITH {SCORES} SELECT id AS SK_ID_CURR, round(m1, 6) AS TARGET FROM scores")
def write_predictions(spark, d):
    out = scores(spark, d).select(F.col("id").alias("SK_ID_CURR"), r6("m1").alias("TARGET"))
    path = io.write_predictions(out, scratch_path(spark, "submission"))
    return io.scan(spark, path, "SK_ID_CURR BIGINT, TARGET DOUBLE", fmt="csv")


@query(
    "union_by_name",
    """SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, NULL::VARCHAR AS name FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_name FROM supplier""",
)
def union_by_name(spark, d):
    left = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    right = table(spark, d, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")
    )
    return assemble.union_by_name(left, right)


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 400")
def top_n(spark, d):
    return (
        table(spark, d, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(400)
    )


@query("limit_rows_rules", "SELECT least(count(*), 1000) AS n, least(count(DISTINCT o_orderkey), 1000) AS n_distinct, 0::BIGINT AS strangers FROM orders")
def limit_rows_rules(spark, d):
    """The row cap gives that many different rows of the table."""
    path = f"{d}/orders.parquet"
    orders = spark.read.parquet(path)
    rows = stored(io.scan(spark, path, orders.schema, limit=1000), "limited")
    strangers = rows.join(orders, "o_orderkey", "left_anti").select(F.count("*")).scalar()
    return rows.agg(F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("n_distinct")).withColumn("strangers", strangers)


@query("limit_rows", "SELECT o_orderkey, coalesce(o_totalprice > 0, false)::INT AS priced FROM orders ORDER BY o_orderkey LIMIT 1000")
def limit_rows(spark, d):
    """The debug row cap of a scan, by an order."""
    path = f"{d}/orders.parquet"
    return io.scan(spark, path, spark.read.parquet(path).schema, limit=1000, order=["o_orderkey"]).select(
        "o_orderkey", E.flag(F.col("o_totalprice") > 0).alias("priced")
    )
