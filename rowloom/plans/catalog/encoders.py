"""Category encoders, folds, nearest neighbours, selection rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.operators import encode, folds, knn, rank, select
from rowloom.plans.catalog.aggregates import rounded
from rowloom.plans.catalog.registry import (
    APPLICANTS,
    FOLDED,
    applicants,
    folded,
    query,
    r6,
    table,
)

_LANGS = ("en", "es", "fr")


@query(
    "one_hot",
    f"""WITH {APPLICANTS} SELECT id, {', '.join(f"coalesce((lang = '{v}')::INT, 0) AS lang_{v}" for v in _LANGS)},
        (lang IS NULL)::INT AS lang_nan FROM applicants""",
)
def one_hot(spark, d):
    a = applicants(spark, d).select("id", "lang")
    return encode.OneHot(["lang"]).fit(a).transform(a)


@query(
    "factorize",
    f"""WITH {APPLICANTS}, f AS (SELECT source, min(id) AS first FROM applicants GROUP BY source),
    c AS (SELECT source, row_number() OVER (ORDER BY first) - 1 AS code FROM f),
    g AS (SELECT lang, row_number() OVER (ORDER BY min(id)) - 1 AS code FROM applicants WHERE lang IS NOT NULL GROUP BY lang)
    SELECT id, c.code AS source_code, coalesce(g.code, -1) AS lang_code
    FROM applicants JOIN c USING (source) LEFT JOIN g USING (lang)""",
)
def factorize(spark, d):
    a = applicants(spark, d).select("id", "source", "lang")
    steps = encode.Factorize("source", "id", "source_code"), encode.Factorize("lang", "id", "lang_code")
    return encode.fit_transform(a, *steps).select("id", "source_code", "lang_code")


@query(
    "label_encode",
    f"""WITH {APPLICANTS}, t AS (SELECT DISTINCT coalesce(lang, 'nan') AS v FROM applicants),
    l AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM t),
    s AS (SELECT source AS v, row_number() OVER (ORDER BY source) - 1 AS code FROM (SELECT DISTINCT source FROM applicants))
    SELECT id, l.code AS lang_label, s.code AS source_label
    FROM applicants a JOIN l ON l.v = coalesce(a.lang, 'nan') JOIN s ON s.v = a.source""",
)
def label_encode(spark, d):
    a = applicants(spark, d).select("id", "source", "lang")
    steps = encode.LabelCode("lang", "lang_label"), encode.LabelCode("source", "source_label")
    return encode.fit_transform(a, *steps).select("id", "lang_label", "source_label")


_NUMS = ["chars", "lines", "e_share"]


@query(
    "groupby_ratio",
    "WITH "
    + APPLICANTS
    + ", "
    + ", ".join(
        f"g_{c} AS (SELECT {c}, "
        + ", ".join(f"avg({n}) AS {n}_m, median({n}) AS {n}_d, stddev_samp({n}) AS {n}_s" for n in _NUMS)
        + f" FROM applicants WHERE {c} IS NOT NULL GROUP BY {c})"
        for c in ("lang", "source")
    )
    + " SELECT id, "
    + ", ".join(
        f"round(g_{c}.{n}_m, 6) AS GB_{c}_{n}_MEAN, round(g_{c}.{n}_d, 6) AS GB_{c}_{n}_MEDIAN, round(g_{c}.{n}_s, 6) AS GB_{c}_{n}_STD, "
        f"round({n} - g_{c}.{n}_m, 6) AS GB_{c}_{n}_DIFF, round({n} / nullif(g_{c}.{n}_m + 1e-6, 0), 6) AS GB_{c}_{n}_RATIO"
        for c in ("lang", "source")
        for n in _NUMS
    )
    + " FROM applicants a LEFT JOIN g_lang ON a.lang = g_lang.lang LEFT JOIN g_source ON a.source = g_source.source",
)
def groupby_ratio(spark, d):
    a = applicants(spark, d)
    out = encode.GroupStats(["lang", "source"], _NUMS).fit(a).transform(a)
    return rounded(out.select("id", *[c for c in out.columns if c.startswith("GB_")]))


@query(
    "frequency_encode",
    f"""WITH {APPLICANTS}, f AS (SELECT coalesce(lang, '__nan__') AS v, count(*) AS n FROM applicants GROUP BY 1),
    g AS (SELECT source AS v, count(*) AS n FROM applicants GROUP BY 1)
    SELECT id, f.n AS lang_FREQ, round(f.n / (SELECT count(*) FROM applicants), 6) AS lang_FREQ_NORM,
           g.n AS source_FREQ, round(g.n / (SELECT count(*) FROM applicants), 6) AS source_FREQ_NORM
    FROM applicants a JOIN f ON f.v = coalesce(a.lang, '__nan__') JOIN g ON g.v = a.source""",
)
def frequency_encode(spark, d):
    a = applicants(spark, d).select("id", "lang", "source")
    out = encode.Frequency(["lang", "source"]).fit(a).transform(a)
    return rounded(out.drop("lang", "source"))


def _te(c: str) -> str:
    """Out-of-fold encoding written per row: label sums of the same category in other folds."""
    return f"""e_{c} AS (
      SELECT a.id, count(b.id) AS n, coalesce(sum(b.target), 0) AS s FROM folded a
      LEFT JOIN folded b ON b.target IS NOT NULL AND a.{c} = b.{c} AND (a.fold IS NULL OR a.fold <> b.fold) GROUP BY a.id)"""


@query(
    "target_encode_oof",
    f"""WITH {FOLDED}, {_te('lang')}, {_te('source')}, g AS (SELECT avg(target) AS g FROM folded)
    SELECT a.id, fold, round(CASE WHEN e_lang.n < 40 THEN g ELSE (e_lang.s + 40 * g) / (e_lang.n + 40) END, 6) AS lang_TE,
           round(CASE WHEN e_source.n < 12 THEN g ELSE (e_source.s + 40 * g) / (e_source.n + 40) END, 6) AS source_TE
    FROM folded a JOIN e_lang ON e_lang.id = a.id JOIN e_source ON e_source.id = a.id, g""",
)
def target_encode_oof(spark, d):
    a = folded(spark, d).select("id", "fold", "target", "lang", "source")
    out = encode.fit_transform(
        a,
        encode.TargetMean(["lang"], "target", min_rows=40),
        encode.TargetMean(["source"], "target", min_rows=12),
    )
    return rounded(out.select("id", "fold", "lang_TE", "source_TE"))


@query(
    "stratified_folds",
    f"WITH {FOLDED} SELECT id, target, fold FROM folded WHERE target IS NOT NULL",
)
def stratified_folds(spark, d):
    return folds.stratified(applicants(spark, d), "id", "target")


@query(
    "group_folds",
    """SELECT o_orderkey, o_custkey,
              (cast('0x' || substr(md5(concat(o_custkey, '-42')), 1, 8) AS BIGINT) % 5)::INT AS fold FROM orders""",
)
def group_folds(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", folds.group_fold("o_custkey").alias("fold"))


def _ordered_sql(c: str, fold: int | None) -> str:
    """Running mean of the label per category over a hashed order; the whole category where a row is not learned from."""
    value, learned = f"coalesce({c}, 'none')", "target IS NOT NULL" + ("" if fold is None else f" AND fold <> {fold}")
    over = f"PARTITION BY {value} ORDER BY md5(concat(id, '-42')), id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    prior = f"(SELECT avg(target) FROM folded WHERE {learned})"
    mean = lambda over: f"(coalesce(sum(target) FILTER (WHERE {learned}) OVER ({over}), 0) + {prior}) / (count(*) FILTER (WHERE {learned}) OVER ({over}) + 1)"
    name = f"{c}_OTS" + ("" if fold is None else str(fold))
    return f"round(CASE WHEN {learned} THEN {mean(over)} ELSE {mean(f'PARTITION BY {value}')} END, 6) AS {name}"


@query("ordered_target", f"WITH {FOLDED} SELECT id, {_ordered_sql('lang', None)}, {_ordered_sql('source', None)} FROM folded")
def ordered_target(spark, d):
    return rounded(encode.ordered_means(folded(spark, d), "id", ["lang", "source"], "target"))


@query("ordered_target_folds", f"WITH {FOLDED} SELECT id, {', '.join(_ordered_sql(c, f) for c in ('lang', 'source') for f in range(5))} FROM folded")
def ordered_target_folds(spark, d):
    return rounded(encode.ordered_means(folded(spark, d), "id", ["lang", "source"], "target", fold="fold", k=5))


@query(
    "balanced_group_folds",
    """WITH s AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
       p AS (SELECT *, (row_number() OVER (ORDER BY n DESC, md5(concat(o_custkey, '-42')), o_custkey) - 1) % 10 AS turn FROM s)
       SELECT o_custkey, n, least(turn, 9 - turn)::INT AS fold FROM p""",
)
def balanced_group_folds(spark, d):
    return folds.balanced_group_folds(table(spark, d, "orders"), "o_custkey")


_KNN = ["chars", "spaces", "lines", "e_share"]


def _z(fill: str) -> str:
    filled = ", ".join(f"coalesce({c}, {fill.format(c=c)}) AS {c}" for c in _KNN)
    return f"""filled AS (SELECT id, target, fold, {filled} FROM folded),
    m AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _KNN)} FROM filled),
    z AS (SELECT id, target, fold, {', '.join(f'round(({c} - m_{c}) / s_{c}, 6) AS z{i}' for i, c in enumerate(_KNN))} FROM filled, m)"""


_DIST = " + ".join(f"(q.z{i} - p.z{i}) * (q.z{i} - p.z{i})" for i in range(4))


def _near(k: int) -> str:
    """Mean label of the k nearest (of all, if there are fewer); ties at the last distance share
    the places that are left."""
    return f"""t{k} AS (SELECT id, leave, sum(s * least(n, {k} - before) / n) / sum(least(n, {k} - before)) AS v FROM cum WHERE before < {k} GROUP BY id, leave)"""


@query(
    "knn_target_mean",
    f"""WITH {FOLDED}, {_z('(SELECT median({c}) FROM folded)')},
    pairs AS (SELECT q.id, 0 AS leave, {_DIST} AS dist, p.target FROM z q JOIN z p ON p.target IS NOT NULL AND q.fold IS DISTINCT FROM p.fold),
    g AS (SELECT id, leave, dist, count(*)::DOUBLE AS n, sum(target)::DOUBLE AS s FROM pairs GROUP BY id, leave, dist),
    cum AS (SELECT *, sum(n) OVER (PARTITION BY id, leave ORDER BY dist) - n AS before FROM g), {_near(50)}, {_near(200)}
    SELECT id, round(t50.v, 6) AS KNN_TARGET_50, round(t200.v, 6) AS KNN_TARGET_200 FROM t50 JOIN t200 USING (id)""",
)
def knn_target_mean(spark, d):
    return rounded(knn.target_mean(folded(spark, d), "id", _KNN, "target", ks=(50, 200), digits=6))


@query(
    "knn_target_fold_avg",
    f"""WITH {FOLDED}, {_z('-999')},
    pairs AS (SELECT q.id, l.leave, {_DIST} AS dist, p.target FROM z q
      JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS leave) l ON q.fold IS NULL OR q.fold = l.leave
      JOIN z p ON p.target IS NOT NULL AND p.fold <> l.leave),
    g AS (SELECT id, leave, dist, count(*)::DOUBLE AS n, sum(target)::DOUBLE AS s FROM pairs GROUP BY id, leave, dist),
    cum AS (SELECT *, sum(n) OVER (PARTITION BY id, leave ORDER BY dist) - n AS before FROM g), {_near(50)}, {_near(200)}
    SELECT id, round(avg(t50.v), 6) AS KNN_TARGET_50, round(avg(t200.v), 6) AS KNN_TARGET_200
    FROM t50 JOIN t200 USING (id, leave) GROUP BY id""",
)
def knn_target_fold_avg(spark, d):
    return rounded(knn.target_mean(folded(spark, d), "id", _KNN, "target", ks=(50, 200), fill=-999, test="fold_avg", digits=6))


_CORR = ["c0", "c1", "c2", "c3", "c4"]


def _corr_frame(spark, d):
    a = applicants(spark, d)
    return a.select(
        "id",
        F.col("chars").alias("c0"),
        F.col("spaces").alias("c1"),
        (F.col("chars") * 2 + F.col("lines")).alias("c2"),
        F.col("e_share").alias("c3"),
        F.col("lines").alias("c4"),
    )


@query(
    "corr_filter",
    f"""WITH {APPLICANTS}, f AS (SELECT id, chars AS c0, spaces AS c1, chars * 2 + lines AS c2, e_share AS c3, lines AS c4
        FROM applicants),
    r AS (SELECT {', '.join(f'corr(c{i}, c{j}) AS r{i}{j}' for j in range(5) for i in range(j))} FROM f),
    l AS (SELECT unnest([{', '.join(f"{{'i': {i}, 'j': {j}, 'r': r{i}{j}}}" for j in range(5) for i in range(j))}], recursive := true) FROM r)
    SELECT j::BIGINT AS position, 'c' || j AS "column", count(*) AS n_earlier FROM l WHERE abs(r) > 0.9 GROUP BY j""",
)
def corr_filter(spark, d):
    return select.correlated_columns(_corr_frame(spark, d), _CORR, 0.9)


@query(
    "null_importance_rule",
    f"""WITH {APPLICANTS}, i AS (SELECT source AS feature, id % 6 - 1 AS run, sum(chars) / 1000 AS importance FROM applicants GROUP BY ALL),
    g AS (SELECT feature, max(importance) FILTER (WHERE run < 0) AS actual,
                 quantile_cont(importance, 0.8) FILTER (WHERE run >= 0) AS null_level FROM i GROUP BY feature)
    SELECT feature, round(actual, 6) AS actual, round(null_level, 6) AS null_level, round(actual / (null_level + 1), 6) AS ratio,
           (actual / (null_level + 1) >= 1)::INT AS keep FROM g""",
)
def null_importance_rule(spark, d):
    """The decision rule on importances per (feature, run)."""
    a = applicants(spark, d)
    table_ = a.groupBy(F.col("source").alias("feature"), (F.col("id") % 6 - 1).alias("run")).agg(
        (F.sum("chars") / 1000).alias("importance")
    )
    return rounded(select.keep_rule(table_))


@query(
    "prediction_corr",
    f"""WITH {APPLICANTS}, f AS (SELECT chars AS c0, spaces AS c1, e_share AS c3, lines AS c4 FROM applicants),
    r AS (SELECT {', '.join(f'corr({a}, {b}) AS {a}{b}' for a in ('c0', 'c1', 'c3', 'c4') for b in ('c0', 'c1', 'c3', 'c4') if a < b)} FROM f)
    {' UNION ALL '.join(f"SELECT '{a}' AS a, '{b}' AS b, " + ('1.0::DOUBLE' if a == b else f'round({min(a, b)}{max(a, b)}, 6)') + " AS r FROM r" for a in ('c0', 'c1', 'c3', 'c4') for b in ('c0', 'c1', 'c3', 'c4'))}""",
)
def prediction_corr(spark, d):
    m = rank.corr_matrix(_corr_frame(spark, d), ["c0", "c1", "c3", "c4"])
    return m.select("a", "b", r6("r").alias("r"))
