"""Model operators. Scores of trees depend on the learner, so those are checked by what holds for any learner;
the same operators with an exact least-squares line are checked value by value."""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from rowloom.operators import oof, select
from rowloom.plans.catalog.registry import (
    APPLICANTS,
    INSTALMENTS,
    applicants,
    folded,
    folds_sql,
    instalments,
    query,
    r6,
    table,
)

_FEATURES = ["chars", "spaces", "lines", "e_share", "toxic"]


def _small_gbt(seed: int = 42):
    return oof.gbt(seed, trees=4, depth=3, cols="all")


@query("oof_score")
def oof_score(spark, d):
    makers = {
        "gbt": _small_gbt,
        "forest": lambda: oof.forest(trees=8, depth=4),
        "logistic": lambda: oof.logistic(rounds=20),
    }
    return oof.oof_fit(folded(spark, d), "id", _FEATURES, "target", makers)


@query("seed_average")
def seed_average(spark, d):
    return oof.seed_average(
        applicants(spark, d), "id", _FEATURES, "target", lambda s: oof.forest(s, trees=6, depth=4)
    )


@query("stack_logistic")
def stack_logistic(spark, d):
    scored = folded(spark, d, 3).withColumns(
        {"s1": F.col("e_share") * 2, "s2": F.log1p("chars") / 10}
    )
    return oof.stack(scored, "id", ["s1", "s2"], "target", raw=["lines"], k=3)


@query("child_submodel_rollup")
def child_submodel_rollup(spark, d):
    """Line items scored against the balance class of their customer; poor customers unlabelled."""
    parent = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") > 0, (F.col("c_acctbal") > 5000).cast("int")).alias("target"),
    )
    child = instalments(spark, d).withColumn("row", F.xxhash64("loan", "t", "due", "quantity", "version", "discount"))
    return oof.child_submodel(
        child, parent, "id", "row", ["due", "paid", "dpd", "quantity"], "target", "INS", _small_gbt, k=2
    )


@query("predict_column_residual")
def predict_column_residual(spark, d):
    a = applicants(spark, d)
    out = oof.predict_column(
        a,
        "id",
        "lines",
        ["chars", "spaces", "e_share", "lang"],
        make=lambda: GBTRegressor(maxIter=4, maxDepth=3, seed=42),
    )
    return out.select("id", r6("APP_lines_PRED").alias("pred"), r6("APP_lines_DIFF").alias("diff"), "APP_lines_MISSING")


@query("importance_select")
def importance_select(spark, d):
    gains = select.gain_importance(applicants(spark, d), "id", _FEATURES, "target", _small_gbt)
    return select.top_importance(gains, 3, must_keep=["e_share"])


@query("null_importance")
def null_importance(spark, d):
    table_ = select.null_importance(
        applicants(spark, d), "id", _FEATURES, "target", lambda s: oof.gbt(s, trees=3, depth=3, cols="all")
    )
    return select.keep_rule(table_)


@query("feature_subsets")
def feature_subsets(spark, d):
    gains = select.gain_importance(applicants(spark, d), "id", _FEATURES, "target", _small_gbt, folds=(0, 1))
    lists = select.subsets(gains, _FEATURES, top=3, without_prefix="e_")
    rows = [(name, i, c) for name, cols in lists.items() for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "subset string, position int, feature string")


@query("model_matrix")
def model_matrix(spark, d):
    from rowloom.plans.matrix import model_matrix as build

    a = folded(spark, d).withColumn("same", F.lit(1)).withColumn("twice", F.col("chars") * 2)
    return build(a, "id", "target").frame


def _line():
    return LinearRegression(labelCol="label", featuresCol="features", solver="normal", regParam=0.0)


def _lines_sql(k: int, seed: int, name: str) -> str:
    """Least-squares lines without one fold each, and the scores of all rows by them."""
    renamed = folds_sql(k, seed).replace("folds", f"{name}_folds").replace("folded AS", f"{name}_rows AS")
    return f"""{renamed},
    {name}_lines AS (SELECT k, regr_slope(target::DOUBLE, chars) AS s, regr_intercept(target::DOUBLE, chars) AS i
        FROM {name}_rows JOIN (SELECT unnest(range({k})) AS k) ON fold <> k WHERE target IS NOT NULL GROUP BY k),
    {name} AS (SELECT id, any_value(target) AS target, any_value(fold) AS fold, avg(s * chars + i) AS score
        FROM {name}_rows JOIN {name}_lines ON fold IS NULL OR fold = k GROUP BY id)"""


@query("oof_line", f"WITH {APPLICANTS}, {_lines_sql(3, 42, 'a')} SELECT id, target, fold, round(score, 6) AS line FROM a")
def oof_line(spark, d):
    scored = oof.oof_fit(folded(spark, d, 3), "id", ["chars"], "target", {"line": _line}, k=3)
    return scored.select("id", "target", "fold", r6("line").alias("line"))


@query(
    "seed_average_line",
    f"""WITH {APPLICANTS}, {_lines_sql(5, 456, 'a')}, {_lines_sql(5, 789, 'b')}, {_lines_sql(5, 1234, 'c')}
    SELECT id, a.target, round((a.score + b.score + c.score) / 3, 6) AS score FROM a JOIN b USING (id) JOIN c USING (id)""",
)
def seed_average_line(spark, d):
    scored = oof.seed_average(applicants(spark, d), "id", ["chars"], "target", lambda seed: _line())
    return scored.select("id", "target", r6("seed_avg").alias("score"))


@query(
    "predict_column_line",
    f"""WITH {APPLICANTS}, l AS (SELECT regr_slope(lines, chars) AS s, regr_intercept(lines, chars) AS i FROM applicants)
    SELECT id, round(s * chars + i, 6) AS pred, round(coalesce(lines - (s * chars + i), 0), 6) AS diff,
           (lines IS NULL)::INT AS APP_lines_MISSING FROM applicants, l""",
)
def predict_column_line(spark, d):
    out = oof.predict_column(applicants(spark, d), "id", "lines", ["chars"], make=_line)
    return out.select("id", r6("APP_lines_PRED").alias("pred"), r6("APP_lines_DIFF").alias("diff"), "APP_lines_MISSING")


@query(
    "child_submodel_line",
    f"""WITH {INSTALMENTS}, p AS (SELECT c_custkey AS id, (c_acctbal > 5000)::INT AS y FROM customer WHERE c_acctbal > 0),
    c AS (SELECT i.id, due, y, CASE WHEN y IS NOT NULL THEN cast('0x' || substr(md5(concat(i.id, '-42')), 1, 8) AS BIGINT) % 2 END AS fold
          FROM instalments i LEFT JOIN p ON p.id = i.id),
    m AS (SELECT k, regr_slope(y::DOUBLE, due) AS s, regr_intercept(y::DOUBLE, due) AS i
          FROM c JOIN (SELECT unnest(range(2)) AS k) ON fold <> k GROUP BY k),
    w AS (SELECT id, CASE WHEN fold IS NULL THEN due * (SELECT avg(s) FROM m) + (SELECT avg(i) FROM m) ELSE due * s + i END AS score
          FROM c LEFT JOIN m ON fold = k)
    SELECT id, round(avg(score), 6) AS INS_SUB_MEAN, round(max(score), 6) AS INS_SUB_MAX, round(min(score), 6) AS INS_SUB_MIN,
           round(stddev_samp(score), 6) AS INS_SUB_STD, count(*) FILTER (WHERE score > 0.15) AS INS_SUB_HIGHRISK FROM w GROUP BY id""",
)
def child_submodel_line(spark, d):
    parent = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") > 0, (F.col("c_acctbal") > 5000).cast("int")).alias("target"),
    )
    child = instalments(spark, d).withColumn("row", F.xxhash64("loan", "t", "due", "quantity", "version", "discount"))
    out = oof.child_submodel(child, parent, "id", "row", ["due"], "target", "INS", _line, k=2)
    return out.select("id", *[r6(f"INS_SUB_{c}").alias(f"INS_SUB_{c}") for c in ("MEAN", "MAX", "MIN", "STD")], "INS_SUB_HIGHRISK")


@query(
    "oof_score_rules",
    f"""WITH {APPLICANTS}, {folds_sql()}
    SELECT fold, count(*) AS n, count(DISTINCT id) AS ids, 0::BIGINT AS bad FROM folded GROUP BY fold""",
)
def oof_score_rules(spark, d):
    """Whatever the learner: one score per row, of its fold, between 0 and 1."""
    scored = oof_score(spark, d)
    bad = F.count_if(~(F.coalesce(F.least("gbt", "forest", "logistic"), F.lit(-1)).between(0, 1) & F.greatest("gbt", "forest", "logistic").between(0, 1)))
    return scored.groupBy("fold").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), bad.alias("bad"))


@query(
    "stack_rules",
    f"""WITH {APPLICANTS} SELECT target, count(*) AS n, 0::BIGINT AS bad FROM applicants GROUP BY target""",
)
def stack_rules(spark, d):
    scored = stack_logistic(spark, d)
    return scored.groupBy("target").agg(F.count("*").alias("n"), F.count_if(~F.coalesce(F.col("stack_lr").between(0, 1), F.lit(False))).alias("bad"))


@query(
    "top_importance_rule",
    f"""WITH {APPLICANTS}, g AS (SELECT source AS feature, greatest(sum(chars) - 5000, 0) AS importance FROM applicants GROUP BY source),
    t AS (SELECT *, row_number() OVER (ORDER BY importance DESC, feature) AS turn FROM g WHERE importance > 0),
    b AS (SELECT feature, importance, 0 AS late, turn FROM t WHERE turn <= 6),
    m AS (SELECT feature, importance, 1 AS late, CASE feature WHEN 'src9' THEN 1 ELSE 2 END AS turn FROM g
          WHERE feature IN ('src9', 'src3') AND feature NOT IN (SELECT feature FROM b))
    SELECT row_number() OVER (ORDER BY late, turn) - 1 AS position, feature, round(importance, 6) AS importance
    FROM (SELECT * FROM b UNION ALL SELECT * FROM m)""",
)
def top_importance_rule(spark, d):
    gains = applicants(spark, d).groupBy(F.col("source").alias("feature")).agg(F.greatest(F.sum("chars") - 5000, F.lit(0.0)).alias("importance"))
    return select.top_importance(gains, 6, ["src9", "src3"]).select("position", "feature", r6("importance").alias("importance"))


@query(
    "feature_subsets_rule",
    f"""WITH {APPLICANTS}, g AS (SELECT source AS feature, sum(chars) AS importance FROM applicants GROUP BY source),
    a AS (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS position FROM g)
    SELECT 'all' AS subset, position, feature FROM a
    UNION ALL SELECT 'top', row_number() OVER (ORDER BY importance DESC, feature) - 1, feature FROM g QUALIFY row_number() OVER (ORDER BY importance DESC, feature) <= 5
    UNION ALL SELECT 'no_prefix', row_number() OVER (ORDER BY feature) - 1, feature FROM g WHERE feature NOT LIKE 'src1%'""",
)
def feature_subsets_rule(spark, d):
    gains = applicants(spark, d).groupBy(F.col("source").alias("feature")).agg(F.sum("chars").alias("importance"))
    names = [r["feature"] for r in gains.orderBy("feature").collect()]
    lists = select.subsets(gains, names, top=5, without_prefix="src1")
    rows = [(name, i, c) for name, cols in lists.items() for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "subset string, position long, feature string")


@query(
    "model_matrix_values",
    f"""WITH {APPLICANTS}, {folds_sql()},
    l AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT coalesce(lang, 'nan') AS v FROM applicants))
    SELECT id, target, fold, l.code AS lang_, round(chars, 6) AS chars_, round(e_share, 6) AS e_share_
    FROM folded JOIN l ON l.v = coalesce(lang, 'nan')""",
)
def model_matrix_values(spark, d):
    """Categories coded, constant and repeated columns dropped, on all labelled rows."""
    from rowloom.plans.matrix import model_matrix as build

    a = folded(spark, d).select("id", "target", "fold", "lang", "chars", F.lit(1).alias("same"), (F.col("chars") * 2 + 1).alias("twice"), "e_share")
    m = build(a, "id", "target").frame
    return m.select("id", "target", "fold", F.col("lang").alias("lang_"), *[r6(c).alias(f"{c}_") for c in m.columns if c in ("chars", "twice", "same", "e_share")])
