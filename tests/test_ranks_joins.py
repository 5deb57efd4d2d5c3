import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rowloom.operators import blend, folds, joins, ordered, rank


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one score, one key and one label."""
    rng = np.random.default_rng(5)
    n = 3000
    p = np.where(np.arange(n) % 3 == 0, 0.5, np.round(rng.random(n), 3))
    y = (rng.random(n) < p).astype(int)
    key = np.where(np.arange(n) % 3 == 1, 7, rng.integers(0, 400, n))
    pdf = pd.DataFrame({"id": np.arange(n), "p": p, "q": rng.random(n), "y": y, "key": key})
    return spark.createDataFrame(pdf).repartition(4).cache(), pdf


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())


@pytest.mark.parametrize("mode", ["small", "large"])
def test_rank_auc_median_positions(skewed, mode, request):
    if mode == "large":
        request.getfixturevalue("large")
    df, pdf = skewed
    got = rank.rank_norm(df, "id", ["p", "q"]).toPandas().sort_values("id")
    for c in ("p", "q"):
        assert np.allclose(got[c], pdf[c].rank(pct=True))
    assert rank.auc(df, "y", "p").first()["auc"] == pytest.approx(brute_auc(pdf.y.values, pdf.p.values))
    by = {r["key"]: r["auc"] for r in rank.auc(df, "y", "p", ["key"]).collect()}
    hot = pdf[pdf.key == 7]
    assert by[7] == pytest.approx(brute_auc(hot.y.values, hot.p.values))
    med = ordered.medians(df, ["p", "q"], ["y"]).toPandas().set_index("y").sort_index()
    assert np.allclose(med[["p_median", "q_median"]], pdf.groupby("y")[["p", "q"]].median())
    placed = folds.positions(df.select("id"), "id", 3).toPandas()
    assert sorted(placed["position"]) == list(range(len(pdf)))
    codes = ordered.dense_codes(df.select(F.col("key").cast("string").alias("k")).distinct(), "k", "code").toPandas()
    assert list(codes.sort_values("code")["k"]) == sorted(pdf.key.astype(str).unique())


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.3)], "y int, p double")
    assert rank.auc(df, "y", "p").first()["auc"] is None


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(skewed, large, how):
    df, pdf = skewed
    one = df.sparkSession.createDataFrame([(k, k * 10) for k in range(0, 400, 2)] + [(7, 70)], "key long, w long")
    hot = joins.hot_keys(df, ["key"], fraction=1.0)
    assert (7,) in [tuple(r) for r in hot.collect()]
    out = joins.skew_join(df, one, ["key"], how, hot).toPandas()
    plain = df.join(one, "key", how).toPandas()
    assert sorted(out.columns) == sorted(plain.columns)
    cols = list(plain.columns)
    a, b = (x[cols].sort_values("id").reset_index(drop=True) for x in (out, plain))
    pd.testing.assert_frame_equal(a, b)


def test_stratified_folds_are_balanced_and_stable(skewed):
    df, pdf = skewed
    f = folds.stratified(df, "id", "y").toPandas()
    sizes = f.groupby(["y", "fold"]).size().unstack()
    assert (sizes.max(axis=1) - sizes.min(axis=1) <= 1).all()
    again = folds.stratified(df.repartition(7), "id", "y").toPandas()
    pd.testing.assert_frame_equal(f.sort_values("id").reset_index(drop=True), again.sort_values("id").reset_index(drop=True))
    other = folds.stratified(df, "id", "y", seed=1).toPandas()
    assert (other.sort_values("id")["fold"].values != f.sort_values("id")["fold"].values).any()


def test_sample_is_exact(skewed):
    df, _ = skewed
    assert folds.sample_n(df, "id", 100).count() == 100
    assert folds.sample_n(df, "id", 10_000).count() == 3000


def test_grids_and_weight_search(skewed):
    df, pdf = skewed
    assert len(blend.pair_grid()) == 21 and len(blend.triple_grid()) == 60
    assert all(abs(sum(w) - 1) < 1e-9 for w in blend.triple_grid())
    capped = blend.simplex_grid(3, 5, 0.6)
    assert capped and max(max(w) for w in capped) <= 0.6
    graded = blend.grid_auc(df, "y", ["p", "q"], blend.pair_grid()).toPandas().sort_values("w_index")
    expected = [brute_auc(pdf.y.values, (a * pdf.p + b * pdf.q).values) for a, b in blend.pair_grid()]
    assert np.allclose(graded["auc"], expected)
    best = blend.best_of(blend.grid_auc(df, "y", ["p", "q"], blend.pair_grid())).first()
    assert best["w_index"] == int(np.argmax(np.round(expected, 12)))
    weights, score = blend.capped_weights(df, "id", "y", ["p", "q"], cap=0.6)
    assert sum(weights.values()) == pytest.approx(1) and max(weights.values()) <= 0.6 + 1e-9
    within = [auc for (a, b), auc in zip(blend.pair_grid(), expected) if max(a, b) <= 0.6]
    assert score >= max(within) - 0.02


@pytest.mark.parametrize(("cols", "cap"), [(["p"], 1.0), (["p", "q"], 0.5), (["p", "q"], 0.55)])
def test_caps_that_leave_little_room(skewed, cols, cap):
    weights, _ = blend.capped_weights(skewed[0], "id", "y", cols, cap=cap)
    assert sum(weights.values()) == pytest.approx(1) and max(weights.values()) <= cap + 1e-9
    with pytest.raises(ValueError, match="cannot sum to 1"):
        blend.capped_weights(skewed[0], "id", "y", cols, cap=0.9 / len(cols))


def test_blend_with_absent_parts(skewed):
    df, pdf = skewed
    out = blend.blend(df, "id", {"p": 0.6, "q": 0.2, "zz": 0.2}, "raw").toPandas().sort_values("id")
    assert np.allclose(out["TARGET"], 0.75 * pdf.p + 0.25 * pdf.q)
    assert blend.blend(df, "id", {"zz": 1.0}) is None
    with pytest.raises(ValueError):
        blend.candidates(df, "id", [("a", {"zz": 1.0}, "raw")])


def _scored(spark, n, seed=8):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": np.arange(n), "y": (rng.random(n) < 0.2).astype(int), "fold": rng.integers(0, 3, n)})
    for c, strength in (("p", 1.0), ("q", 0.8), ("r", 0.2)):
        pdf[c] = np.round(pdf.y * strength + rng.normal(size=n), 4 if c == "q" else 12)
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("by", [(), ("fold",)])
def test_leading_vectors_hold_the_winner(spark, by, monkeypatch):
    df = _scored(spark, 3000)
    grid = blend.triple_grid()
    for bins in (4, 256):
        monkeypatch.setattr(blend, "BINS", bins)
        whole = {tuple(r) for r in blend.best_of(blend.grid_auc(df, "y", ["p", "q", "r"], grid, by), by).collect()}
        assert {tuple(r) for r in blend.best_vector(df, "y", ["p", "q", "r"], grid, by).collect()} == whole
    edges = np.tile(np.linspace(-2, 2, 9), (len(grid), 1))
    bounds = blend.auc_bounds(df, "y", ["p", "q", "r"], dict(enumerate(grid)), edges, by).join(blend.grid_auc(df, "y", ["p", "q", "r"], grid, by), [*by, "w_index"])
    assert bounds.where("low <= auc AND auc <= high").count() == len(grid) * (3 if by else 1)


def test_few_vectors_are_graded_exactly(spark):
    """Of 60 vectors over 200,000 rows at most two reach the stage that shuffles a row per vector; ties all do."""
    df = _scored(spark, 200_000)
    assert blend.leading_vectors(df, "y", ["p", "q", "r"], blend.triple_grid()).count() <= 2
    same = blend.leading_vectors(df, "y", ["p", "q"], [(1.0, 0.0), (0.5, 0.0), (0.2, 0.8), (0.0, 1.0)])
    assert sorted(r[0] for r in same.collect()) in ([0, 1], [2])
    one_class = df.withColumn("y", F.lit(1))
    assert blend.best_vector(one_class.limit(50), "y", ["p", "q"], [(1.0, 0.0), (0.0, 1.0)]).first()["auc"] is None
    nothing, two = df.limit(0), [(1.0, 0.0), (0.0, 1.0)]
    assert blend.best_vector(nothing, "y", ["p", "q"], two).collect() == blend.best_of(blend.grid_auc(nothing, "y", ["p", "q"], two)).collect()


def test_refined_weights_beat_their_neighbours(spark):
    """The search ends where no shift of the smallest size helps, graded by plain pair counts."""
    df = _scored(spark, 2500, seed=3)
    pdf = df.toPandas().sort_values("id")
    ranks = pdf[["p", "q", "r"]].rank() / len(pdf)
    weights, score = blend.capped_weights(df, "id", "y", ["p", "q", "r"], cap=0.6, step=0.05)
    w = np.array([weights[c] for c in ("p", "q", "r")])
    assert abs(w.sum() - 1) < 1e-9 and w.max() <= 0.6 + 1e-9
    grade = lambda v: brute_auc(pdf.y.values, ranks.to_numpy() @ np.array(v))
    assert abs(grade(w) - score) < 1e-9
    assert all(grade(v) <= score + 1e-12 for v in blend._neighbours(tuple(w), 0.05, 0.6))
    assert all(grade(v) <= score + 1e-12 for v in blend.simplex_grid(3, 5, 0.6))


def _pair_share(y, x):
    """Positives above negatives, ties half, by comparing all pairs; NaN is one value, above all others."""
    x = np.where(np.isnan(x), np.inf, x)
    below = (x[:, None] > x[None, :]) + 0.5 * (x[:, None] == x[None, :])
    pairs = y.sum() * (1 - y).sum()
    return float((y[:, None] * (1 - y)[None, :] * below).sum() / pairs) if pairs else None


def test_grid_auc_in_passes_and_ranges(spark, monkeypatch):
    """Scores travel once per range, packed, a few vectors at a time; settings are as before afterwards."""
    rng = np.random.default_rng(5)
    n = 300
    frame = pd.DataFrame({
        "g": [None if i % 7 == 0 else "ab"[i % 2] for i in range(n)], "y": [None if i % 11 == 0 else int(i % 3 == 0) for i in range(n)],
        "p": rng.normal(size=n).round(2), "q": rng.choice([0.0, -0.0, 1e300, np.nan, -5.0], n), "r": rng.choice([0.25, 0.5], n),
    })
    missing = rng.random(n) < 0.05
    values = [(r.g, None if pd.isna(r.y) else int(r.y), None if m else float(r.p), float(r.q), float(r.r)) for r, m in zip(frame.itertuples(), missing)]
    df = spark.createDataFrame(values, "g string, y int, p double, q double, r double")
    grid = [(1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0), (0.5, 0.2, 0.3), (-1.0, 0.0, 0.5)]
    for name, value in (("PASS_VALUES", 1), ("PASS_VECTORS", 2), ("RANGE_ROWS", 40), ("HELD_ROWS", 50)):
        monkeypatch.setattr(blend, name, value)
    names = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = [spark.conf.get(x) for x in names]
    for by in ([], ["g"]):
        got = {(*[r[c] for c in by], r["w_index"]): r["auc"] for r in blend.grid_auc(df, "y", ["p", "q", "r"], grid, by).collect()}
        kept = [v for v in values if v[1] is not None and v[2] is not None]
        for key in {tuple(v[:1]) if by else () for v in kept}:
            part = [v for v in kept if not by or v[:1] == key]
            y, s = np.array([v[1] for v in part]), np.array([v[2:] for v in part], float)
            for i, w in enumerate(grid):
                with np.errstate(over="ignore"):
                    want = _pair_share(y, s[:, 0] * w[0] + s[:, 1] * w[1] + s[:, 2] * w[2])
                assert got.pop((*key, i)) == pytest.approx(want, abs=1e-12)
        assert not got
    assert [spark.conf.get(x) for x in names] == before


def test_packed_runs():
    rng = np.random.default_rng(3)
    for scores in (rng.normal(size=500), rng.integers(0, 3, 500) * 1.0, np.array([-np.inf, np.inf, 1e-300, -1.0]), np.array([2.0])):
        keys = np.sort(blend._keys(scores.copy()))
        runs = list(blend._runs(keys, np.sort(blend._keys(rng.choice(scores, 2)))))
        back = [np.repeat(blend._unpacked(f, n, p), 1 if c is None else np.frombuffer(c, np.int64)) for _, f, n, p, c in runs]
        assert np.array_equal(np.concatenate(back), keys)
        assert [r[0] for r in runs] == sorted({r[0] for r in runs})
    tied = list(blend._runs(np.zeros(1_000_000, np.int64), np.array([], np.int64)))
    assert len(tied) == 1 and tied[0][2] == 1 and len(tied[0][3]) == 0
    counts = [np.array([3, 1]), None, np.array([2])]
    assert blend._pairs([np.array([1, 5]), np.array([1, 7]), np.array([5])], [1, 0, 0], counts) == (4, 4, 3 * 0.5 + 1 + 2 * 0.5)
