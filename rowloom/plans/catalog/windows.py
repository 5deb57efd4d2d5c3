"""Last-k / first-k slices, latest values, group broadcasts, global ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.operators import joins, rank, rollup
from rowloom.operators.rollup import Slice
from rowloom.plans.catalog.aggregates import rounded, sql_stats
from rowloom.plans.catalog.registry import BALANCES, DECISIONS, MODELS, SCORES, balances, decisions, query, r6, scores

_KS = (1, 3, 5, 10)
_ALL = ["mean", "max", "min", "sum", "var"]


def _placed(direction: str) -> str:
    return f"""p AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t {direction} NULLS LAST, loan {direction}) AS rn
        FROM (SELECT id, loan, CASE WHEN priority <> '1-URGENT' THEN t END AS t, amount FROM decisions))"""


def _untimed(spark, d):
    """Decisions of which the urgent ones have no time."""
    return decisions(spark, d).withColumn("t", F.when(F.col("priority") != "1-URGENT", F.col("t")))


@query(
    "last_k_rollup",
    f"WITH {DECISIONS}, {_placed('DESC')} SELECT id, "
    + ", ".join(sql_stats("amount", f"DEC_LAST_{k}_AMOUNT", _ALL, f"rn <= {k}", 4) for k in _KS)
    + " FROM p GROUP BY id",
)
def last_k_rollup(spark, d):
    slices = [Slice(f"LAST_{k}", last_k=k, order=("t", "loan")) for k in _KS]
    return rounded(rollup.rollup(_untimed(spark, d), "id", "DEC", ["amount"], slices=slices), 4)


@query(
    "first_k_rollup",
    f"WITH {DECISIONS}, {_placed('ASC')} SELECT id, "
    + ", ".join(sql_stats("amount", f"DEC_FIRST_{k}_AMOUNT", _ALL, f"rn <= {k}", 4) for k in (2, 4))
    + " FROM p GROUP BY id",
)
def first_k_rollup(spark, d):
    slices = [Slice(f"FIRST_{k}", first_k=k, order=("t", "loan")) for k in (2, 4)]
    return rounded(rollup.rollup(_untimed(spark, d), "id", "DEC", ["amount"], slices=slices), 4)


@query(
    "latest_values",
    f"""WITH {BALANCES} SELECT id, max_by(value, row(t, "row")) FILTER (WHERE value IS NOT NULL) AS EV_LAST_VALUE,
        max_by(status, row(t, "row")) AS EV_LAST_STATUS, max(t) AS EV_LAST_T FROM balances GROUP BY id""",
)
def latest_values(spark, d):
    return rollup.latest_values(balances(spark, d), "id", ["value", "status", "t"], ["t", "row"], "EV_LAST")


@query(
    "group_transform",
    f"""WITH {BALANCES} SELECT "row", id, count(value) OVER (PARTITION BY id) AS n,
        round(value - avg(value) OVER (PARTITION BY id), 6) AS diff,
        round(value / nullif(avg(value) OVER (PARTITION BY id) + 1e-6, 0), 6) AS ratio FROM balances""",
)
def group_transform(spark, d):
    """Group count and mean on every row: aggregate, then join, so that a hot group is no
    single task."""
    rows = balances(spark, d).select("row", "id", "value")
    stats = rows.groupBy("id").agg(F.count("value").alias("n"), F.avg("value").alias("_mean"))
    joined = joins.skew_join(rows, stats, ["id"], "left")
    return joined.select(
        "row",
        "id",
        "n",
        r6(F.col("value") - F.col("_mean")).alias("diff"),
        r6(F.try_divide(F.col("value"), F.col("_mean") + 1e-6)).alias("ratio"),
    )


@query(
    "rank_normalize",
    f"""WITH {SCORES}, n AS (SELECT id, m1, m2, CASE WHEN target = 1 THEN m3 END AS m3 FROM scores)
    SELECT id, {', '.join(f'''round(CASE WHEN {m} IS NOT NULL THEN (rank() OVER (PARTITION BY {m} IS NULL ORDER BY {m})
        + (count(*) OVER (PARTITION BY {m}) - 1) / 2.0::DOUBLE) / count({m}) OVER () END, 6) AS {m}''' for m in MODELS)} FROM n""",
)
def rank_normalize(spark, d):
    s = scores(spark, d).withColumn("m3", F.when(F.col("target") == 1, F.col("m3")))
    return rounded(rank.rank_norm(s, "id", MODELS))
