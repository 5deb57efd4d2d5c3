"""Rollups of child rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.operators import rollup, schema
from rowloom.operators.rollup import Decay, Slice, Trend
from rowloom.plans.catalog.registry import BALANCES, DECISIONS, INSTALMENTS, balances, decisions, instalments, query


def rounded(df, digits: int = 6, skip=("id",)):
    """Doubles rounded for comparison."""
    return df.select(
        *[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" and f.name not in skip else F.col(f.name) for f in df.schema.fields]
    )


def sql_stats(c: str, name: str, stats, cond: str | None = None, digits: int = 6) -> str:
    """The statistics of one column in SQL, with this library's rules for sums and empty slices."""
    f = f" FILTER (WHERE {cond})" if cond else ""
    forms = {
        "mean": f"round(avg({c}){f}, {digits})",
        "max": f"round(max({c}){f}, {digits})",
        "min": f"round(min({c}){f}, {digits})",
        "var": f"round(var_samp({c}){f}, {digits})",
        "std": f"round(stddev_samp({c}){f}, {digits})",
        "sum": f"round(coalesce(sum({c}){f}, 0), {digits})"
        if not cond
        else f"round(CASE WHEN count(*){f} > 0 THEN coalesce(sum({c}){f}, 0) END, {digits})",
    }
    return ", ".join(f"{forms[s]} AS {name}_{s.upper()}" for s in stats)


@query(
    "num_agg",
    f"""WITH {INSTALMENTS} SELECT id, {sql_stats('due', 'INS_DUE', ['min', 'max', 'mean', 'sum', 'var'])},
        {sql_stats("number::DOUBLE", "INS_NUMBER", ["min", "max", "mean", "sum", "var"])}
        FROM instalments GROUP BY id""",
)
def num_agg(spark, d):
    rows = instalments(spark, d).withColumn("number", F.col("number").cast("double"))
    return rounded(rollup.rollup(rows, "id", "INS", ["due", "number"], num_stats=["min", "max", "mean", "sum", "var"]))


@query(
    "entity_rollup",
    f"""WITH {BALANCES}, b AS (SELECT *, (value > 20)::INT AS big FROM balances)
    SELECT id, {sql_stats('value', 'EV_VALUE', ['mean', 'max', 'min', 'sum', 'var'], digits=4)},
    {', '.join(f"round(avg((status = '{s}')::INT), 4) AS EV_STATUS_{s.upper()}_MEAN, sum((status = '{s}')::INT)::BIGINT AS EV_STATUS_{s.upper()}_SUM" for s in ('click', 'error', 'purchase', 'signup', 'view'))},
    0.0::DOUBLE AS EV_STATUS_NAN_MEAN, 0::BIGINT AS EV_STATUS_NAN_SUM,
    round(avg(big), 4) AS EV_BIG_MEAN, coalesce(sum(big), 0)::BIGINT AS EV_BIG_SUM FROM b GROUP BY id""",
)
def entity_rollup(spark, d):
    rows = balances(spark, d).withColumn("big", (F.col("value") > 20).cast("int"))
    numeric, text = schema.column_classes(rows.drop("id", "row", "t"))
    binary = schema.binary_columns(rows, numeric)
    return rounded(
        rollup.rollup(
            rows, "id", "EV", [c for c in numeric if c not in binary], schema.categories(rows, text), binary
        ),
        4,
    )


@query(
    "category_share",
    f"""WITH {DECISIONS} SELECT id, round(avg((status = 'F')::INT::DOUBLE) FILTER (WHERE status IS NOT NULL) * count(status) / count(*), 6) AS DEC_STATUS_F_MEAN_X,
        round(sum(coalesce((status = 'F')::INT, 0)) / count(*), 6) AS DEC_STATUS_F_MEAN,
        round(sum(coalesce((status = 'O')::INT, 0)) / count(*), 6) AS DEC_STATUS_O_MEAN,
        round(sum((status IS NULL)::INT) / count(*), 6) AS DEC_STATUS_NAN_MEAN
        FROM decisions GROUP BY id""".replace(
        "round(avg((status = 'F')::INT::DOUBLE) FILTER (WHERE status IS NOT NULL) * count(status) / count(*), 6) AS DEC_STATUS_F_MEAN_X,\n        ",
        "",
    ),
)
def category_share(spark, d):
    rows = decisions(spark, d)
    return rounded(rollup.rollup(rows, "id", "DEC", categories=schema.categories(rows, ["status"]), cat_stats=["mean"]))


_WINDOWS = ((180, "6M"), (365, "1Y"), (730, "2Y"))


@query(
    "window_rollup",
    f"""WITH {DECISIONS} SELECT c_custkey AS id, {', '.join(f"DEC_{n}_AMOUNT_{s}" for _, n in _WINDOWS for s in ('MEAN', 'MAX', 'SUM'))},
        {', '.join(f'DEC_{n}_COUNT' for _, n in _WINDOWS)}
        FROM customer LEFT JOIN (SELECT id, {', '.join(sql_stats('amount', f'DEC_{n}_AMOUNT', ['mean', 'max', 'sum'], f't >= -{days}') for days, n in _WINDOWS)},
        {', '.join(f'nullif(count(*) FILTER (WHERE t >= -{days}), 0) AS DEC_{n}_COUNT' for days, n in _WINDOWS)}
        FROM decisions GROUP BY id) w ON w.id = c_custkey""",
)
def window_rollup(spark, d):
    from rowloom.operators.assemble import join_features
    from rowloom.plans.catalog.registry import table

    slices = [Slice(n, f"t >= -{days}", shares=False, count=True) for days, n in _WINDOWS]
    features = rollup.rollup(decisions(spark, d), "id", "DEC", ["amount"], slices=slices, num_stats=["mean", "max", "sum"])
    base = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return rounded(join_features(base, [features], "id"))


@query(
    "status_slice_rollup",
    f"""WITH {DECISIONS} SELECT id, {', '.join(sql_stats('amount', f'DEC_{s}_AMOUNT', ['mean', 'sum', 'max', 'min'], f"status = '{s}'") for s in 'FO')},
        {', '.join(f"nullif(count(*) FILTER (WHERE status = '{s}'), 0) AS DEC_{s}_COUNT" for s in 'FO')},
        {sql_stats('amount', 'DEC_LARGE_AMOUNT', ['mean', 'sum', 'max', 'min'], 'amount > 300')},
        nullif(count(*) FILTER (WHERE amount > 300), 0) AS DEC_LARGE_COUNT FROM decisions GROUP BY id""",
)
def status_slice_rollup(spark, d):
    slices = [Slice(s, f"status = '{s}'", shares=False, count=True) for s in "FO"]
    slices.append(Slice("LARGE", "amount > 300", shares=False, count=True))
    return rounded(
        rollup.rollup(decisions(spark, d), "id", "DEC", ["amount"], slices=slices, num_stats=["mean", "sum", "max", "min"])
    )


@query(
    "ordinal_slice_rollup",
    f"""WITH {INSTALMENTS} SELECT id, {', '.join(sql_stats('paid', f'INS_NUM_{i}_PAID', ['mean', 'max', 'min', 'sum', 'var'], f'number = {i}', 4) for i in range(1, 5))},
        {sql_stats('paid', 'INS_PAST_DUE_PAID', ['mean', 'max', 'min', 'sum', 'var'], 'dpd > 0', 4)} FROM instalments GROUP BY id""",
)
def ordinal_slice_rollup(spark, d):
    slices = [Slice(f"NUM_{i}", f"number = {i}") for i in range(1, 5)] + [Slice("PAST_DUE", "dpd > 0")]
    return rounded(rollup.rollup(instalments(spark, d), "id", "INS", ["paid"], slices=slices), 4)


def _decay(c: str, rate: float) -> str:
    return f"""round(sum(CASE WHEN {c} IS NOT NULL THEN {c} * exp({rate}::DOUBLE * t) END)
        / nullif(sum(CASE WHEN {c} IS NOT NULL THEN exp({rate}::DOUBLE * t) END), 0), 6)"""


@query(
    "time_weighted_mean",
    f"""WITH {BALANCES} SELECT id, {_decay('value', 0.02)} AS EV_VALUE_TWMEAN FROM balances GROUP BY id""",
)
def time_weighted_mean(spark, d):
    return rounded(rollup.rollup(balances(spark, d), "id", "EV", slices=(), decays=[Decay(["value"], "t", 0.02)]))


_SLOPE = """round(CASE WHEN count(*) FILTER (WHERE {c} IS NOT NULL) >= 3 THEN
    covar_pop({c}, t) FILTER (WHERE {c} IS NOT NULL) * count({c})
    / (var_pop(t) FILTER (WHERE {c} IS NOT NULL) * count({c}) + 1e-8) END, 6)"""


@query(
    "trend_slope",
    f"""WITH {DECISIONS}, n AS (SELECT id, t, CASE WHEN status IS NOT NULL THEN amount END AS amount FROM decisions)
    SELECT id, {_SLOPE.format(c='amount')} AS DEC_AMOUNT_TREND FROM n GROUP BY id""",
)
def trend_slope(spark, d):
    rows = decisions(spark, d).withColumn("amount", F.when(F.col("status").isNotNull(), F.col("amount")))
    return rounded(rollup.rollup(rows, "id", "DEC", slices=(), trends=[Trend(["amount"], "t")]))


@query(
    "two_level_rollup",
    f"""WITH {INSTALMENTS}, loans AS (
      SELECT id, loan, max(dpd / 9.7::DOUBLE) AS dpd_max, avg(dpd / 9.7::DOUBLE) AS dpd_mean, avg((dpd > 0)::INT) AS late_rate, count(*) AS n
      FROM instalments GROUP BY id, loan)
    SELECT id, {', '.join(sql_stats(c, f'PL_{c.upper()}', ['mean', 'max', 'std']) for c in ('dpd_max', 'dpd_mean', 'late_rate', 'n'))}
    FROM loans GROUP BY id""",
)
def two_level_rollup(spark, d):
    rows = instalments(spark, d).withColumns(
        {"late": (F.col("dpd") > 0).cast("int"), "dpd": F.col("dpd") / F.lit(9.7)}
    )
    inner = {
        "PL_DPD_MAX": ("dpd", "max"),
        "PL_DPD_MEAN": ("dpd", "mean"),
        "PL_LATE_RATE": ("late", "mean"),
        "PL_N": ("loan", "size"),
    }
    return rounded(rollup.two_level(rows, "id", "loan", inner))


@query(
    "score_rollup",
    f"""WITH {INSTALMENTS} SELECT id, round(avg(discount), 6) AS INS_SUB_MEAN, max(discount) AS INS_SUB_MAX,
        min(discount) AS INS_SUB_MIN, round(stddev_samp(discount), 6) AS INS_SUB_STD,
        count(*) FILTER (WHERE discount > 0.055::DOUBLE) AS INS_SUB_HIGHRISK FROM instalments GROUP BY id""",
)
def score_rollup(spark, d):
    from rowloom.operators.oof import score_rollup as roll

    return rounded(roll(instalments(spark, d), "id", "discount", "INS", 0.055))


@query(
    "rates_and_counts",
    f"""WITH {DECISIONS} SELECT id, count(*) AS n, round(avg(coalesce((status = 'F')::INT, 0)), 6) AS approval,
        round(avg((amount > 300)::INT), 6) AS large_rate FROM decisions GROUP BY id""",
)
def rates_and_counts(spark, d):
    from rowloom.functions.expr import flag

    rates = {
        "n": "count(1)",
        "approval": F.avg(flag(F.col("status") == "F")),
        "large_rate": F.avg(flag(F.col("amount") > 300)),
    }
    out = rollup.rollup(decisions(spark, d), "id", "", slices=(), extra=rates)
    return rounded(out)


@query(
    "nunique_any",
    f"""WITH {INSTALMENTS} SELECT id, count(DISTINCT version) AS VER_VERSION_NUNIQUE, max(version) AS VER_VERSION_MAX,
        round(avg(version), 6) AS VER_VERSION_MEAN, (max(dpd) > 0)::INT AS VER_DPD_ANY FROM instalments GROUP BY id""",
)
def nunique_any(spark, d):
    wanted = {"version": ["nunique", "max", "mean"], "dpd": ["any"]}
    return rounded(rollup.rollup(instalments(spark, d), "id", "VER", slices=[Slice(num=wanted)]))


@query(
    "nunique_slices",
    f"""WITH {INSTALMENTS} SELECT id, count(DISTINCT version) AS VER_VERSION_NUNIQUE, count(DISTINCT dpd) AS VER_DPD_NUNIQUE,
        max(dpd) AS VER_DPD_MAX, count(DISTINCT version) FILTER (WHERE dpd > 0) AS VER_LATE_VERSION_NUNIQUE,
        count(DISTINCT dpd) FILTER (WHERE dpd > 0) AS VER_LATE_DPD_NUNIQUE, count(DISTINCT dpd) FILTER (WHERE version > 2) AS VERSIONS
        FROM instalments GROUP BY id""",
)
def nunique_slices(spark, d):
    """Several counts of distinct values, with conditions, beside other statistics."""
    slices = [
        Slice(num={"version": ["nunique"], "dpd": ["nunique", "max"]}),
        Slice("LATE", "dpd > 0", num={"version": ["nunique"], "dpd": ["nunique"]}),
    ]
    return rollup.rollup(instalments(spark, d), "id", "VER", slices=slices, extra={"VERSIONS": rollup.Distinct("dpd", "version > 2")})


@query(
    "pivot_count",
    """SELECT l_orderkey AS loan, min(l_linenumber) AS BB_NUMBER_MIN, max(l_linenumber) AS BB_NUMBER_MAX, count(*) AS BB_NUMBER_SIZE,
              count(*) FILTER (WHERE l_returnflag = 'A') AS BB_STATUS_A, count(*) FILTER (WHERE l_returnflag = 'N') AS BB_STATUS_N,
              count(*) FILTER (WHERE l_returnflag = 'R') AS BB_STATUS_R FROM lineitem GROUP BY l_orderkey""",
)
def pivot_count(spark, d):
    from rowloom.plans.catalog.registry import table

    rows = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("loan"), F.col("l_linenumber").alias("number"), F.col("l_returnflag").alias("status")
    )
    values = schema.categories(rows, ["status"], with_null=False)["status"]
    return rollup.pivot_count(rows, "loan", "status", values, "BB", "number")


@query(
    "recent_overall_ratio",
    f"""WITH {DECISIONS}, a AS (SELECT id, avg(amount) AS whole, avg(amount) FILTER (WHERE t >= -365) AS recent,
        avg(amount) FILTER (WHERE t >= -730) AS recent2 FROM decisions GROUP BY id),
    l AS (SELECT id, avg(amount) AS last3 FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t DESC, loan) AS rn FROM decisions)
          WHERE rn <= 3 GROUP BY id)
    SELECT id, round(recent / nullif(whole, 0), 6) AS r12, round(recent2 / nullif(whole, 0), 6) AS r24,
           round(last3 / nullif(whole, 0), 6) AS r_last3, round(recent / (whole + 1), 6) AS r12_plus
    FROM a LEFT JOIN l USING (id)""",
)
def recent_overall_ratio(spark, d):
    rows = decisions(spark, d).withColumn("back", -F.col("loan"))
    slices = [
        Slice(),
        Slice("RECENT_12M", "t >= -365"),
        Slice("RECENT_24M", "t >= -730"),
        Slice("LAST_3", last_k=3, order=("t", "back")),
    ]
    out = rollup.rollup(rows, "id", "DEC", ["amount"], slices=slices, num_stats=["mean"])
    pairs = [
        ("DEC_RECENT_12M_AMOUNT_MEAN", "DEC_AMOUNT_MEAN", "r12"),
        ("DEC_RECENT_24M_AMOUNT_MEAN", "DEC_AMOUNT_MEAN", "r24"),
        ("DEC_LAST_3_AMOUNT_MEAN", "DEC_AMOUNT_MEAN", "r_last3"),
    ]
    out = rollup.ratio_of(rollup.ratio_of(out, pairs), [(pairs[0][0], pairs[0][1], "r12_plus")], 1)
    return rounded(out.select("id", "r12", "r24", "r_last3", "r12_plus"))
