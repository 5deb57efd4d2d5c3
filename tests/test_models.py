"""Properties of the model operators."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rowloom.operators import folds, oof, rank, select


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    n = 400
    x = rng.normal(size=n)
    pdf = pd.DataFrame({"id": np.arange(n), "x": x, "noise": rng.normal(size=n)})
    pdf["y"] = (x + 0.3 * rng.normal(size=n) > 0).astype(int)
    rows = [(int(r.id), r.x, None if r.id % 9 == 0 else r.noise, None if r.id % 5 == 0 else int(r.y)) for r in pdf.itertuples()]
    df = spark.createDataFrame(rows, "id int, x double, noise double, y int")
    return folds.with_folds(df, "id", "y", 2).cache()


def test_each_id_is_scored_once_and_the_signal_is_found(data):
    makers = {"forest": lambda: oof.forest(trees=5, depth=4), "logistic": lambda: oof.logistic(rounds=20)}
    out = oof.oof_fit(data, "id", ["x", "noise"], "y", makers, k=2).cache()
    assert out.count() == 400 and out.select("id").distinct().count() == 400
    assert out.where("forest IS NULL OR logistic IS NULL").count() == 0
    for row in rank.auc_by_model(out, "y", list(makers)).collect():
        assert row["auc"] > 0.8


def test_a_row_never_sees_a_model_of_its_own_fold(data):
    """Flipping the labels of fold 0 leaves the scores of fold 0 as they were."""
    makers = {"logistic": lambda: oof.logistic(rounds=20)}
    flipped = data.withColumn("y", F.when(F.col("fold") == 0, 1 - F.col("y")).otherwise(F.col("y")))
    before, after = (
        oof.oof_fit(df, "id", ["x", "noise"], "y", makers, k=2).where("fold = 0").toPandas().sort_values("id")
        for df in (data, flipped)
    )
    assert np.allclose(before["logistic"], after["logistic"])
    assert (before["y"].values != after["y"].values).all()


def test_shuffled_labels_are_a_permutation(data):
    labelled = data.where("y IS NOT NULL")
    a = select.shuffled_labels(labelled, "id", "y", 100).toPandas().sort_values("id")
    b = labelled.select("id", "y").toPandas().sort_values("id")
    assert a.y.sum() == b.y.sum() and (a.y.values != b.y.values).any() and len(a) == len(b)


def test_split_counts_and_keep_rule(spark, data):
    rows = oof.feature_vector(data.where("y IS NOT NULL"), ["x", "noise"]).selectExpr("cast(y AS double) AS label", "features")
    counts = {r["feature"]: r["splits"] for r in select.split_counts(oof.forest(trees=3, depth=2).fit(rows), ["x", "noise"]).collect()}
    assert counts["x"] > 0 and set(counts) == {"x", "noise"}
    table = spark.createDataFrame(
        [("a", -1, 10.0), ("a", 0, 1.0), ("a", 1, 2.0), ("b", -1, 1.0), ("b", 0, 5.0), ("b", 1, 5.0)],
        "feature string, run int, importance double",
    )
    got = {r["feature"]: (r["null_level"], r["keep"]) for r in select.keep_rule(table).collect()}
    assert got["a"][1] == 1 and got["b"] == (5.0, 0) and got["a"][0] == pytest.approx(1.8)


def test_top_importance_keeps_the_musts(spark):
    gains = spark.createDataFrame([("a", 0.5), ("b", 0.4), ("c", 0.0), ("d", 0.1)], "feature string, importance double")
    kept = {r["feature"] for r in select.top_importance(gains, 2, ["c"]).collect()}
    assert kept == {"a", "b", "c"}
    assert [r["feature"] for r in select.top_importance(gains, 4, ["c", "a"]).orderBy("position").collect()] == ["a", "b", "d", "c"]
    assert [r["feature"] for r in select.top_importance(gains, 1).collect()] == ["a"]


def test_child_scores_roll_up_per_parent(spark, data):
    parent = data.select("id", "y")
    child = data.selectExpr("id", "explode(sequence(1, 3)) AS part", "x").selectExpr("id", "id * 10 + part AS row", "x + part / 10 AS v")
    out = oof.child_submodel(child, parent, "id", "row", ["v"], "y", "P", lambda: oof.forest(trees=3, depth=3), k=2).toPandas()
    assert len(out) == 400 and (out.P_SUB_MIN <= out.P_SUB_MEAN + 1e-12).all() and (out.P_SUB_HIGHRISK <= 3).all()


def test_residuals(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, 5.0, 3.0)], "id int, e double, APP_e_PRED double")
    got = [tuple(r) for r in oof.residuals(df, "e").select("APP_e_DIFF", "APP_e_MISSING").orderBy("APP_e_MISSING").collect()]
    assert got == [(2.0, 0), (0.0, 1)]
    none = oof.predict_column(df.drop("APP_e_PRED").where("id = 1"), "id", "e", ["id"])
    assert [tuple(r) for r in none.select("APP_e_PRED", "APP_e_DIFF", "APP_e_MISSING").collect()] == [(None, 0.0, 1)]


def _newton(x, y, reg):
    """Ridge logistic regression on the mean loss, without a penalty on the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, reg), 0.0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(x) + np.diag(penalty), x.T @ (p - y) / len(x) + penalty * w)
    return w


def test_stacking_equals_newton_steps(data):
    """Scores of the second level, model by model, against a plain solution."""
    out = oof.stack(data, "id", ["x"], "y", raw=["noise"], c=0.35, k=3, seed=789).toPandas().sort_values("id")
    rows = folds.with_folds(data, "id", "y", 3, 789).toPandas().sort_values("id").reset_index(drop=True)
    x = np.column_stack([rows.x, rows.noise.fillna(oof.MISSING)])
    y, fold = rows.y.to_numpy(float), rows.fold.to_numpy(float)
    n = (~np.isnan(y)).sum() * 2 / 3
    scores = []
    for f in range(3):
        train = ~np.isnan(y) & (fold != f)
        w = _newton(x[train], y[train], 1 / (0.35 * n))
        scores.append(1 / (1 + np.exp(-(np.column_stack([x, np.ones(len(x))]) @ w))))
    want = np.where(np.isnan(fold), np.mean(scores, axis=0), np.choose(np.nan_to_num(fold).astype(int), scores))
    assert np.allclose(out.stack_lr.to_numpy(), want, atol=2e-4)


def test_a_row_of_a_fold_passes_one_model(spark, data):
    """The plan of each fold's branch holds one model; reading and fitting skip the other folds' files."""
    rows = oof.stored_parts(oof.feature_vector(data, ["x"]).selectExpr("id", "cast(y AS double) AS label", "fold", "features"), "fold")
    seen = []

    class Counted:
        def __init__(self, f):
            self.f = f

        def transform(self, df):
            seen.append((self.f, df))
            return df.withColumn("prediction", F.lit(float(self.f)))

    out = oof.score_folds(rows, {"m": [Counted(0), Counted(1)]})
    got = {r["id"]: r["m"] for r in out.collect()}
    want = {r["id"]: 0.5 if r["fold"] is None else float(r["fold"]) for r in data.collect()}
    assert got == want and [f for f, _ in seen] == [0, 1, 0, 1]
    own = seen[1][1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in own


def test_saved_models_are_taken_up(data, tmp_path):
    calls = []

    def make():
        calls.append(1)
        return oof.logistic(rounds=20)

    first = oof.oof_fit(data, "id", ["x", "noise"], "y", {"l": make}, k=2, save_to=str(tmp_path)).toPandas().sort_values("id")
    again = oof.oof_fit(data, "id", ["x", "noise"], "y", {"l": make}, k=2, save_to=str(tmp_path)).toPandas().sort_values("id")
    assert len(calls) == 2 and np.allclose(first.l, again.l)


def _ordered(pdf, fold, weight=1.0):
    """Running label means of the category, row by row."""
    import hashlib

    learned = pdf.y.notna() & (True if fold is None else pdf.fold != fold)
    prior = pdf.y[learned].mean()
    turn = pdf.id.map(lambda i: hashlib.md5(f"{i}-42".encode()).hexdigest())
    out = []
    for i in pdf.index:
        same = learned & (pdf.c.fillna("-") == (pdf.c[i] if isinstance(pdf.c[i], str) else "-"))
        if learned[i]:
            same &= turn < turn[i]
        out.append((pdf.y[same].sum() + weight * prior) / (same.sum() + weight))
    return out


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_ordered_means_and_their_use(spark, broadcast):
    from rowloom.operators import encode

    rng = np.random.default_rng(1)
    n = 200
    cat = [None if i % 11 == 0 else "hot" if i % 3 == 0 else "abcdef"[i % 6] for i in range(n)]
    rows = [(i, cat[i], float(rng.normal()), None if i % 7 == 0 else int(rng.random() < (0.9 if cat[i] == "hot" else 0.2))) for i in range(n)]
    df = folds.with_folds(spark.createDataFrame(rows, "id int, c string, x double, y int"), "id", "y", 3).cache()
    pdf = df.toPandas().sort_values("id").reset_index(drop=True)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        plain = encode.ordered_means(df, "id", ["c"], "y").toPandas().sort_values("id")
        per_fold = encode.ordered_means(df, "id", ["c"], "y", fold="fold", k=3).toPandas().sort_values("id")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert np.allclose(plain.c_OTS, _ordered(pdf, None))
    for f in range(3):
        assert np.allclose(per_fold[f"c_OTS{f}"], _ordered(pdf, f))
    out = oof.oof_fit(df, "id", ["x", "c"], "y", {"l": lambda: oof.logistic(0.0, 50)}, k=3, categorical=["c"])
    assert out.count() == n and rank.auc(out, "y", "l").first()["auc"] > 0.75


def test_binned_matrix_keeps_order_and_missing_values(spark, data):
    m = select.binned_matrix(data.withColumn("one", F.lit(7.0)).withColumn("none", F.lit(None).cast("double")), "id", ["x", "noise", "one", "none"])
    rows = m.join(data, "id").toPandas()
    bins = np.array([r.toArray() for r in rows.features])
    order = np.argsort(rows.x.to_numpy())
    assert (np.diff(bins[order, 0]) >= 0).all() and len(set(bins[:, 0])) > 20 and bins[:, 0].max() < 32
    missing = rows.noise.isna().to_numpy()
    assert len(set(bins[missing, 1])) == 1 and not set(bins[missing, 1]) & set(bins[~missing, 1])
    assert len(set(bins[:, 2])) == 1 and len(set(bins[:, 3])) == 1
    small = lambda s: oof.gbt(s, trees=2, depth=2, cols="all")
    out = select.null_importance(data, "id", ["x", "noise"], "y", small, runs=2, k=2).collect()
    assert {(r["feature"], r["run"]) for r in out} == {(c, r) for c in ("x", "noise") for r in (-1, 0, 1)}
    true = {r["feature"]: r["importance"] for r in out if r["run"] == -1}
    assert true["x"] > true["noise"]


def test_tables_by_key_join_without_moving(large):
    from rowloom.session import stored_by

    spark = large
    wide = stored_by(spark.range(1000).withColumn("a", F.col("id") * 2), "id", "wide")
    other = stored_by(spark.range(1000).withColumn("b", F.col("id") * 3), "id", "other")
    plan = wide.join(other, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    moved = wide.join(spark.range(500).withColumn("c", F.lit(1)), "id")._jdf.queryExecution().executedPlan().toString()
    assert moved.count("Exchange hashpartitioning") == 1 and wide.join(other, "id").count() == 1000
