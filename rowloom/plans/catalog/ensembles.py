"""Evaluation, weight searches, blends."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.operators import blend, rank
from rowloom.operators.encode import fitted
from rowloom.plans.catalog.aggregates import rounded
from rowloom.plans.catalog.registry import MODELS, SCORES, query, r6, scores

_RANKS = "ranks AS (SELECT id, target, fold, " + ", ".join(
    f"(rank() OVER (ORDER BY {m}) + (count(*) OVER (PARTITION BY {m}) - 1) / 2.0::DOUBLE) / count(*) OVER () AS {m}"
    for m in MODELS
) + " FROM scores)"


def _auc(source: str, score: str, by: str = "") -> str:
    """Rank-sum AUC with average ranks."""
    part = f"PARTITION BY {by}" if by else ""
    tie = f"PARTITION BY {by + ', ' if by else ''}{score}"
    keys = by + ", " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""(SELECT {keys}(sum(r) FILTER (WHERE target = 1) - sum(target) * (sum(target) + 1) / 2.0::DOUBLE)
      / (sum(target) * sum(1 - target))::DOUBLE AS auc, sum(target)::BIGINT AS n_pos, sum(1 - target)::BIGINT AS n_neg
      FROM (SELECT *, rank() OVER ({part} ORDER BY {score}) + (count(*) OVER ({tie}) - 1) / 2.0::DOUBLE AS r FROM {source})
      {group})"""


@query(
    "roc_auc",
    f"WITH {SCORES} "
    + " UNION ALL ".join(f"SELECT '{m}' AS model, round(auc, 6) AS auc, n_pos, n_neg FROM {_auc('scores', m)}" for m in MODELS),
)
def roc_auc(spark, d):
    return rounded(rank.auc_by_model(scores(spark, d), "target", MODELS))


@query(
    "roc_auc_by_fold",
    f"WITH {SCORES} SELECT fold, round(auc, 6) AS auc, n_pos, n_neg FROM {_auc('scores', 'm2', 'fold')}",
)
def roc_auc_by_fold(spark, d):
    return rounded(rank.auc(scores(spark, d), "target", "m2", ["fold"]))


@query(
    "rank_corr",
    f"""WITH {SCORES}, {_RANKS} {' UNION ALL '.join(f"SELECT '{a}' AS a, '{b}' AS b, " + ('1.0::DOUBLE' if a == b else f'round(corr({a}, {b}), 6)') + ' AS r FROM ranks' + (' LIMIT 1' if False else '') + (' WHERE id = (SELECT min(id) FROM ranks)' if a == b else '') for a in MODELS for b in MODELS)}""",
)
def rank_corr(spark, d):
    m = rank.corr_matrix(scores(spark, d), MODELS, "id", "spearman")
    return m.select("a", "b", r6("r").alias("r"))


@query(
    "anchor_correlations",
    f"""WITH {SCORES} SELECT 'm2' AS model, round(corr(m1, m2), 6) AS r FROM scores
        UNION ALL SELECT 'm3', round(corr(m1, m3), 6) FROM scores ORDER BY r, model""",
)
def anchor_correlations(spark, d):
    return rank.anchor_correlations(rank.corr_matrix(scores(spark, d), MODELS), "m1").select("model", r6("r").alias("r"))


@query("fixed_blend", f"WITH {SCORES} SELECT id, round(0.4::DOUBLE * m1 + 0.3::DOUBLE * m2 + 0.3::DOUBLE * m3, 6) AS TARGET, round(0.7::DOUBLE * m1 + 0.3::DOUBLE * m2, 6) AS two FROM scores")
def fixed_blend(spark, d):
    return rounded(
        scores(spark, d).select(
            "id", blend.mix({"m1": 0.4, "m2": 0.3, "m3": 0.3}).alias("TARGET"), blend.mix({"m1": 0.7, "m2": 0.3}).alias("two")
        )
    )


#: The weight vectors by their rules: even steps of two, the nested steps of three, and fifths within a cap.
_PAIRS_SQL = "SELECT a AS w_index, a * 0.05::DOUBLE AS w_m1, 1 - a * 0.05::DOUBLE AS w_m2 FROM range(21) t(a)"
_TRIPLES_SQL = """SELECT row_number() OVER (ORDER BY a, b) - 1 AS w_index, f AS w_m1, s AS w_m2, 1 - f - s AS w_m3 FROM (
      SELECT a, b, f, CASE WHEN n = 0 THEN 0 ELSE b * (rest / n) END AS s FROM (
        SELECT *, unnest(range(n + 1)) AS b FROM (
          SELECT a, a * 0.1::DOUBLE AS f, 1 - a * 0.1::DOUBLE AS rest, floor((1 - a * 0.1::DOUBLE) / 0.1::DOUBLE)::INT AS n FROM range(11) t(a))))"""
_CAPPED_SQL = """SELECT row_number() OVER (ORDER BY a, b) - 1 AS w_index, a / 5.0::DOUBLE AS w_m1, b / 5.0::DOUBLE AS w_m2, (5 - a - b) / 5.0::DOUBLE AS w_m3
      FROM range(4) t(a), range(4) u(b) WHERE 5 - a - b BETWEEN 0 AND 3"""


def _graded(grid: str, cols, source, by: str = "") -> str:
    weights = ", ".join(f"w_{c}" for c in cols)
    mixed = " + ".join(f"{c} * w_{c}" for c in cols)
    keys = (by + ", " if by else "") + f"w_index, {weights}"
    return f"""grid AS ({grid}),
    mixed AS (SELECT {source}.*, w_index, {weights}, {mixed} AS mix FROM {source}, grid),
    graded AS (SELECT * FROM {_auc('mixed', 'mix', keys)})"""


@query(
    "weight_grid_search",
    f"""WITH {SCORES}, {_graded(_TRIPLES_SQL, MODELS, 'scores')}
    SELECT w_index, {', '.join(f'round(w_{m}, 6) AS w_{m}' for m in MODELS)}, round(auc, 6) AS auc FROM graded""",
)
def weight_grid_search(spark, d):
    return rounded(blend.grid_auc(scores(spark, d), "target", MODELS, blend.triple_grid()))


_PAIR = ["m1", "m2"]


@query(
    "weight_search_by_fold",
    f"""WITH {SCORES}, {_graded(_PAIRS_SQL, _PAIR, 'scores', 'fold')},
    best AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY auc DESC, w_index) AS turn FROM graded)
    SELECT fold, w_index, round(w_m1, 6) AS w_m1, round(w_m2, 6) AS w_m2, round(auc, 6) AS auc FROM best WHERE turn = 1""",
)
def weight_search_by_fold(spark, d):
    return rounded(blend.best_vector(scores(spark, d), "target", _PAIR, blend.pair_grid(), ["fold"]))


_CAPPED = blend.simplex_grid(3, 5, 0.6)


@query(
    "constrained_rank_blend",
    f"""WITH {SCORES}, {_RANKS}, {_graded(_CAPPED_SQL, MODELS, 'ranks')},
    best AS (SELECT *, row_number() OVER (ORDER BY auc DESC, w_index) AS turn FROM graded)
    SELECT w_index, {', '.join(f'round(w_{m}, 6) AS w_{m}' for m in MODELS)}, round(auc, 6) AS auc FROM best WHERE turn = 1""",
)
def constrained_rank_blend(spark, d):
    s = scores(spark, d)
    # The search reads the ranks several times.
    ranks = fitted(rank.rank_norm(s, "id", MODELS).join(s.select("id", "target"), "id"))
    return rounded(blend.best_vector(ranks, "target", MODELS, _CAPPED))


@query("constrained_rank_blend_refined")
def constrained_rank_blend_refined(spark, d):
    """The same search with finer rounds; returns the blended test scores."""
    s = scores(spark, d)
    weights, _ = blend.capped_weights(s, "id", "target", MODELS)
    return rounded(blend.blend(s, "id", weights, "rank"))


@query(
    "pick_best_candidate",
    f"""WITH {SCORES}, c AS (SELECT id, target, 0.5::DOUBLE * m1 + 0.5::DOUBLE * m2 AS blend, m1 AS stack FROM scores)
    SELECT candidate, auc FROM (
      SELECT 'blend' AS candidate, round(auc, 6) AS auc FROM {_auc('c', 'blend')}
      UNION ALL SELECT 'stack', round(auc, 6) FROM {_auc('c', 'stack')}) ORDER BY auc DESC, candidate LIMIT 1""",
)
def pick_best_candidate(spark, d):
    s = scores(spark, d).select("target", blend.mix({"m1": 0.5, "m2": 0.5}).alias("blend"), F.col("m1").alias("stack"))
    table = rank.auc_by_model(s, "target", ["blend", "stack"]).withColumnRenamed("model", "candidate")
    return rounded(blend.pick_best(table.select("candidate", "auc")))


@query("blend_rank", f"WITH {SCORES}, {_RANKS} SELECT id, round(m1 * 0.85::DOUBLE + m2 * 0.15::DOUBLE, 6) AS TARGET FROM ranks")
def blend_rank(spark, d):
    return rounded(blend.blend(scores(spark, d), "id", {"m1": 0.85, "m2": 0.15}, "rank"))


@query("blend_raw", f"WITH {SCORES} SELECT id, round(m1 * 0.7::DOUBLE + m2 * 0.2::DOUBLE + m3 * 0.1::DOUBLE, 6) AS TARGET FROM scores")
def blend_raw(spark, d):
    return rounded(blend.blend(scores(spark, d), "id", {"m1": 0.7, "m2": 0.2, "m3": 0.1}, "raw"))


@query(
    "blend_renormalized",
    f"WITH {SCORES} SELECT id, round(m1 * (0.65::DOUBLE / 0.8::DOUBLE) + m3 * (0.15::DOUBLE / 0.8::DOUBLE), 6) AS TARGET FROM scores",
)
def blend_renormalized(spark, d):
    return rounded(blend.blend(scores(spark, d), "id", {"m1": 0.65, "m3": 0.15, "m9": 0.2}, "raw"))


_TABLE = [
    ("a", {"m1": 0.9, "m2": 0.1}, "rank"),
    ("b", {"m1": 0.75, "m2": 0.15, "m3": 0.1}, "raw"),
    ("c", {"m1": 0.7, "m3": 0.2, "m8": 0.1}, "rank"),
    ("d", {"m1": 0.7, "m8": 0.3}, "raw"),
    ("e", {"m2": 0.5, "m3": 0.5}, "raw"),
]


@query(
    "blend_candidates",
    f"""WITH {SCORES}, {_RANKS}
    SELECT id, 'a' AS candidate, round(m1 * 0.9::DOUBLE + m2 * 0.1::DOUBLE, 6) AS TARGET FROM ranks
    UNION ALL SELECT id, 'b', round(m1 * 0.75::DOUBLE + m2 * 0.15::DOUBLE + m3 * 0.1::DOUBLE, 6) FROM scores
    UNION ALL SELECT id, 'c', round(m1 * (0.7::DOUBLE / 0.9::DOUBLE) + m3 * (0.2::DOUBLE / 0.9::DOUBLE), 6) FROM ranks""",
)
def blend_candidates(spark, d):
    return rounded(blend.candidates(scores(spark, d), "id", _TABLE, anchor="m1"))
