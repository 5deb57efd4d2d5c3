"""Assembly joins, membership, two-hop rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.operators import assemble, rollup
from rowloom.operators.rollup import Slice
from rowloom.plans.catalog.registry import APPLICANTS, BALANCES, DECISIONS, SCORES, applicants, balances, decisions, query, r6, scores, table


@query(
    "join_feature_tables",
    f"""WITH {DECISIONS}, {BALANCES},
    d AS (SELECT id, count(*) AS dec_count, round(avg(amount), 6) AS dec_amount_mean FROM decisions GROUP BY id),
    b AS (SELECT id, count(*) AS bal_count, round(avg(value), 6) AS bal_value_mean FROM balances GROUP BY id)
    SELECT c_custkey AS id, dec_count AS DEC_COUNT, dec_amount_mean AS DEC_AMOUNT_MEAN, bal_count AS BAL_COUNT,
           bal_value_mean AS BAL_VALUE_MEAN
    FROM customer LEFT JOIN d ON d.id = c_custkey LEFT JOIN b ON b.id = c_custkey""",
)
def join_feature_tables(spark, d):
    base = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    dec = rollup.rollup(decisions(spark, d), "id", "DEC", ["amount"], slices=[Slice(count=True)], num_stats=["mean"])
    bal = rollup.rollup(balances(spark, d), "id", "BAL", ["value"], slices=[Slice(count=True)], num_stats=["mean"])
    nothing = base.select("id")
    joined = assemble.join_features(base, [dec, nothing, bal], "id")
    return joined.select(
        "id", "DEC_COUNT", r6("DEC_AMOUNT_MEAN").alias("DEC_AMOUNT_MEAN"), "BAL_COUNT", r6("BAL_VALUE_MEAN").alias("BAL_VALUE_MEAN")
    )


@query(
    "two_hop_rollup",
    f"""WITH {DECISIONS},
    g AS (SELECT l_orderkey AS loan, min(l_linenumber) AS lo, max(l_linenumber) AS hi, count(*) AS n,
                 avg((l_returnflag = 'A')::INT) AS a, avg((l_returnflag = 'N')::INT) AS nn, avg((l_returnflag = 'R')::INT) AS r,
                 avg((l_returnflag IS NULL)::INT) AS nul
          FROM lineitem GROUP BY l_orderkey)
    SELECT id, min(lo) AS CHILD_BB_NUMBER_MIN_MIN, max(hi) AS CHILD_BB_NUMBER_MAX_MAX, coalesce(sum(n), 0)::BIGINT AS CHILD_BB_COUNT_SUM,
           round(avg(a), 6) AS CHILD_BB_STATUS_A_MEAN_MEAN, round(avg(nn), 6) AS CHILD_BB_STATUS_N_MEAN_MEAN,
           round(avg(r), 6) AS CHILD_BB_STATUS_R_MEAN_MEAN, round(avg(nul), 6) AS CHILD_BB_STATUS_NAN_MEAN_MEAN
    FROM decisions LEFT JOIN g USING (loan) GROUP BY id""",
)
def two_hop_rollup(spark, d):
    grand = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("loan"), F.col("l_linenumber").alias("number"), F.col("l_returnflag").alias("status")
    )
    first = rollup.rollup(
        grand, "loan", "BB", ["number"], {"status": ["A", "N", "R", None]}, slices=[Slice(count=True)],
        num_stats=["min", "max"], cat_stats=["mean"],
    )
    child = decisions(spark, d).join(first, "loan", "left")
    shares = [f"BB_STATUS_{s}_MEAN" for s in ("A", "N", "R", "NAN")]
    out = rollup.rollup(
        child, "id", "CHILD",
        slices=[Slice(num={"BB_NUMBER_MIN": ["min"], "BB_NUMBER_MAX": ["max"], "BB_COUNT": ["sum"], **{s: ["mean"] for s in shares}})],
    )
    return out.select(*[r6(c).alias(c) if c.endswith("MEAN_MEAN") else F.col(c) for c in out.columns])


@query(
    "label_child_rows",
    """SELECT o_orderkey, o_custkey, o_totalprice, c_mktsegment AS segment, (c_acctbal > 5000)::INT AS rich
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def label_child_rows(spark, d):
    parent = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_mktsegment").alias("segment"),
        (F.col("c_acctbal") > 5000).cast("int").alias("rich"),
    )
    child = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return assemble.label_children(child, parent, "o_custkey")


@query(
    "blend_align_check",
    f"""WITH {SCORES}, a AS (SELECT id FROM scores WHERE m1 > 0.1), b AS (SELECT id FROM scores)
    SELECT (SELECT count(*) FROM a) AS n_left, (SELECT count(*) FROM b) AS n_right,
           (SELECT count(*) FROM a JOIN b USING (id)) AS n_joined,
           ((SELECT count(*) FROM a JOIN b USING (id)) = (SELECT count(*) FROM a)
             AND (SELECT count(*) FROM a JOIN b USING (id)) = (SELECT count(*) FROM b))::INT AS aligned""",
)
def blend_align_check(spark, d):
    s = scores(spark, d)
    return assemble.align_check(s.where(F.col("m1") > 0.1), s, "id")


_TRAIN = "rich AS (SELECT c_custkey FROM customer WHERE c_acctbal > 2000)"


@query(
    "semi_members",
    f"WITH {_TRAIN} SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM rich)",
)
def semi_members(spark, d):
    ids = table(spark, d, "customer").where("c_acctbal > 2000").select(F.col("c_custkey").alias("o_custkey"))
    return assemble.members(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ids, "o_custkey")


@query(
    "anti_members",
    f"WITH {_TRAIN} SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM rich)",
)
def anti_members(spark, d):
    ids = table(spark, d, "customer").where("c_acctbal > 2000").select(F.col("c_custkey").alias("o_custkey"))
    return assemble.non_members(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ids, "o_custkey")


@query(
    "share_completed",
    f"""WITH {DECISIONS} SELECT id, round(nullif(count(*) FILTER (WHERE status = 'F'), 0) / count(*), 6) AS rate
        FROM decisions GROUP BY id""",
)
def share_completed(spark, d):
    hits = rollup.stat("size", "id", "status = 'F'")
    return rollup.rollup(
        decisions(spark, d), "id", "", slices=(), extra={"rate": hits / F.count(F.lit(1))}
    ).select("id", r6("rate").alias("rate"))


@query(
    "residual_summary",
    f"""WITH {APPLICANTS}, p AS (SELECT *, chars / 100 AS p1, spaces / 50 AS p2 FROM applicants),
    q AS (SELECT id, p1, p2, coalesce(lines - p1, 0) AS d1, coalesce(e_share - p2, 0) AS d2, (lines IS NULL)::INT AS m1,
                 (e_share IS NULL)::INT AS m2 FROM p)
    SELECT id, m1 AS lines_missing, m2 AS share_missing, round((p1 + p2) / 2, 6) AS pred_mean,
           round(sqrt(pow(p1 - (p1 + p2) / 2, 2) + pow(p2 - (p1 + p2) / 2, 2)), 6) AS pred_std,
           round(abs(d1) + abs(d2), 6) AS diff_abs_sum,
           round(sqrt(pow(d1 - (d1 + d2) / 2, 2) + pow(d2 - (d1 + d2) / 2, 2)), 6) AS diff_std FROM q""",
)
def residual_summary(spark, d):
    from rowloom.operators import oof

    a = applicants(spark, d).withColumns({"APP_lines_PRED": F.col("chars") / 100, "APP_e_share_PRED": F.col("spaces") / 50})
    for target in ("lines", "e_share"):
        a = oof.residuals(a, target)
    s = oof.residual_summary(a, ["lines", "e_share"], group="X")
    return s.select(
        "id",
        F.col("APP_lines_MISSING").alias("lines_missing"),
        F.col("APP_e_share_MISSING").alias("share_missing"),
        r6("APP_X_PRED_MEAN").alias("pred_mean"),
        r6("APP_X_PRED_STD").alias("pred_std"),
        r6("APP_X_DIFF_ABS_SUM").alias("diff_abs_sum"),
        r6("APP_X_DIFF_STD").alias("diff_std"),
    )
