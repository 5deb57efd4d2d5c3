import numpy as np
import pandas as pd
import pytest

from rowloom.operators import encode, select


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(1)
    n = 900
    cat = np.where(np.arange(n) < 300, "hot", rng.choice(["b", "c", "d"], n)).astype(object)
    cat[rng.random(n) < 0.05] = None
    pdf = pd.DataFrame({"id": np.arange(n), "cat": cat, "x": rng.normal(size=n), "fold": np.arange(n) % 5})
    pdf["y"] = np.where(np.arange(n) % 4 == 0, np.nan, (rng.random(n) < 0.3).astype(float))
    pdf.loc[pdf.y.isna(), "fold"] = np.nan
    rows = [tuple(None if (isinstance(v, float) and v != v) else v for v in r) for r in pdf.itertuples(index=False)]
    rows = [(int(i), c, float(x), None if f is None else int(f), None if y is None else int(y)) for i, c, x, f, y in rows]
    return spark.createDataFrame(rows, "id int, cat string, x double, fold int, y int").cache(), pdf


@pytest.mark.parametrize("mode", ["small", "large"])
def test_target_mean_matches_a_loop(people, mode, request):
    if mode == "large":
        request.getfixturevalue("large")
    df, pdf = people
    got = encode.TargetMean(["cat"], "y", smoothing=40, min_rows=60).fit(df).transform(df).toPandas().sort_values("id")
    train = pdf[pdf.y.notna()]
    g = train.y.mean()
    expected = []
    for _, r in pdf.iterrows():
        seen = train if np.isnan(r.fold) else train[train.fold != r.fold]
        own = seen[seen["cat"] == r["cat"]] if r["cat"] is not None else seen.iloc[:0]
        expected.append(g if len(own) < 60 else (own.y.sum() + 40 * g) / (len(own) + 40))
    assert np.allclose(got["cat_TE"], expected)
    assert len(got) == len(pdf)


def test_group_stats_and_frequency(people):
    df, pdf = people
    got = encode.fit_transform(df, encode.GroupStats(["cat"], ["x"]), encode.Frequency(["cat"])).toPandas().sort_values("id").reset_index(drop=True)
    by = pdf.groupby("cat").x
    assert np.allclose(got["GB_cat_x_MEDIAN"].astype(float), pdf["cat"].map(by.median()).astype(float), equal_nan=True)
    assert np.allclose(got["GB_cat_x_STD"].astype(float), pdf["cat"].map(by.std()).astype(float), equal_nan=True)
    filled = pdf["cat"].fillna("__nan__")
    assert (got["cat_FREQ"].values == filled.map(filled.value_counts()).values).all()


def test_codes(people):
    df, pdf = people
    got = encode.fit_transform(df, encode.Factorize("cat", "id", "f"), encode.LabelCode("cat", "l")).toPandas().sort_values("id")
    assert (got["f"].values == pd.factorize(pdf["cat"])[0]).all()
    text = pdf["cat"].fillna("nan")
    assert (got["l"].values == text.map({v: i for i, v in enumerate(sorted(text.unique()))}).values).all()
    hot = encode.OneHot(["cat"]).fit(df).transform(df)
    assert [c for c in hot.columns if c.startswith("cat_")] == ["cat_b", "cat_c", "cat_d", "cat_hot", "cat_nan"]


def test_unseen_category_falls_back(people, spark):
    df, pdf = people
    enc = encode.TargetMean(["cat"], "y", min_rows=1).fit(df)
    new = spark.createDataFrame([("never", None)], "cat string, fold int")
    assert enc.transform(new).first()["cat_TE"] == pytest.approx(pdf.y.mean())


def test_correlation_filter_uses_pairwise_complete_rows(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=500)
    pdf = pd.DataFrame({"id": np.arange(500), "a": a, "b": a * 2 + 1e-4 * rng.normal(size=500), "c": rng.normal(size=500)})
    pdf["d"] = pdf["b"] * -1
    pdf["k"] = 1.0
    rows = [tuple(None if (j == 2 and i % 7 == 0) else v for j, v in enumerate(r)) for i, r in enumerate(pdf.values.tolist())]
    df = spark.createDataFrame([(int(r[0]), *r[1:]) for r in rows], "id int, a double, b double, c double, d double, k double").repartition(3)
    pairs = select.pair_correlations(df, ["a", "b", "c", "d", "k"]).toPandas().set_index(["i", "j"])["r"]
    masked = pdf.copy()
    masked.loc[masked.index % 7 == 0, "b"] = np.nan
    assert pairs[0, 1] == pytest.approx(masked["a"].corr(masked["b"]))
    assert pairs[1, 2] == pytest.approx(masked["b"].corr(masked["c"]))
    assert np.isnan(pairs[0, 4])
    assert select.corr_filter(df, ["a", "b", "c", "d", "k"], 0.985) == ["a", "c", "k"]
