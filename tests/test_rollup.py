import pytest
from conftest import rows

from rowloom.operators import rollup as R
from rowloom.operators.rollup import Decay, Slice, Trend

ROWS = [
    (1, -1, 10.0, "a"), (1, -2, None, "b"), (1, -400, 30.0, None), (1, -500, 50.0, "a"),
    (2, -5, None, "a"),
    (3, -7, 1.0, "b"), (3, -7, 2.0, "b"), (3, -7, 4.0, "b"),
    (None, -1, 99.0, "a"),
]


@pytest.fixture(scope="module")
def child(spark):
    return spark.createDataFrame(ROWS, "id long, t int, v double, c string").cache()


def test_sums_variances_and_empty_slices(child):
    out = R.rollup(child, "id", "P", ["v"], slices=[Slice(count=True), Slice("OLD", "t < -100", count=True)])
    got = {r["id"]: r for r in out.collect()}
    assert set(got) == {1, 2, 3}  # rows without a key are dropped
    assert got[2]["P_V_SUM"] == 0 and got[2]["P_V_MEAN"] is None and got[2]["P_COUNT"] == 1
    assert got[2]["P_V_VAR"] is None
    assert got[2]["P_OLD_V_SUM"] is None and got[2]["P_OLD_COUNT"] is None
    assert got[1]["P_OLD_V_SUM"] == 80.0 and got[1]["P_OLD_COUNT"] == 2
    assert got[3]["P_V_VAR"] == pytest.approx(7 / 3)


def test_shares_count_missing_as_category(child):
    out = R.rollup(child, "id", "P", categories={"c": ["a", "b", None]}, cat_stats=["mean"]).where("id = 1").first()
    assert (out["P_C_A_MEAN"], out["P_C_B_MEAN"], out["P_C_NAN_MEAN"]) == (0.5, 0.25, 0.25)


def test_last_and_first_k(spark):
    df = spark.createDataFrame(
        [(1, None, 5.0, 0), (1, -3, 1.0, 1), (1, -1, 2.0, 2), (1, -1, 3.0, 3)], "id int, t int, v double, tie int"
    )
    slices = [Slice(f"LAST_{k}", last_k=k, order=("t", "tie")) for k in (1, 2, 4)]
    slices += [Slice("FIRST_1", first_k=1, order=("t", "tie"))]
    row = R.rollup(df, "id", "P", ["v"], slices=slices, num_stats=["sum"]).first()
    assert row["P_LAST_1_V_SUM"] == 3.0 and row["P_LAST_2_V_SUM"] == 5.0
    assert row["P_LAST_4_V_SUM"] == 11.0  # the row without a time comes last
    assert row["P_FIRST_1_V_SUM"] == 1.0


def test_rank_slices_prune_rows_before_the_shuffle(child):
    out = R.rollup(child, "id", "P", ["v"], slices=[Slice("LAST_2", last_k=2, order=("t", "v"))])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange hashpartitioning")


def test_slices_share_one_shuffle(child):
    slices = [Slice(), Slice("A", "c = 'a'"), Slice("R", "t >= -10")]
    plan = R.rollup(child, "id", "P", ["v"], slices=slices)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_trend_needs_three_rows_and_flat_time_gives_zero(child):
    out = R.rollup(child, "id", "P", slices=(), trends=[Trend(["v"], "t")])
    got = {r["id"]: r["P_V_TREND"] for r in out.collect()}
    assert got[2] is None and got[3] == 0.0
    t, v = [-1, -400, -500], [10.0, 30.0, 50.0]
    mt, mv = sum(t) / 3, sum(v) / 3
    slope = sum((a - mt) * (b - mv) for a, b in zip(t, v)) / (sum((a - mt) ** 2 for a in t) + 1e-8)
    assert got[1] == pytest.approx(slope)


def test_decay_uses_complete_rows(child):
    import math

    out = R.rollup(child, "id", "P", slices=(), decays=[Decay(["v"], "t", 0.01)])
    got = {r["id"]: r["P_V_TWMEAN"] for r in out.collect()}
    w = [math.exp(0.01 * t) for t in (-1, -400, -500)]
    assert got[1] == pytest.approx(sum(a * b for a, b in zip(w, (10, 30, 50))) / sum(w))
    assert got[2] is None


def test_latest_value_is_per_column(child):
    out = R.latest_values(child, "id", ["v", "c"], ["t", "v"], "L")
    assert rows(out, "id") == [(1, 10.0, "a"), (2, None, "a"), (3, 4.0, "b")]


def test_all_slices_take_one_shuffle(child):
    slices = [Slice(count=True), Slice("A", "c = 'a'"), Slice("B", "t > 1")]
    out = R.rollup(child, "id", "P", ["v", "t"], {"c": ["a", None]}, slices=slices)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Join" not in plan


def test_distinct_counts_beside_a_wide_rollup(spark):
    data = [(1, 0.0, "a", 1), (1, -0.0, "b", 2), (1, 2.5, None, 3), (2, None, "a", 1), (2, float("nan"), "a", 5), (3, None, None, 1), (None, 1.0, "z", 1)]
    df = spark.createDataFrame(data, "id int, v double, c string, t int")
    slices = [Slice(num={"v": ["nunique", "max"], "c": ["nunique"]}), Slice("L", "t >= 2", num={"v": ["nunique"], "c": ["nunique", "size"]})]
    out = R.rollup(df, "id", "P", slices=slices, extra={"X": R.Distinct("t", "c = 'a'")})
    assert out.columns == ["id", "P_V_NUNIQUE", "P_V_MAX", "P_C_NUNIQUE", "P_L_V_NUNIQUE", "P_L_C_NUNIQUE", "P_L_C_SIZE", "X"]
    got = {r[0]: tuple(r[1:2] + r[3:6] + r[7:]) for r in out.collect()}
    assert got == {1: (2, 2, 2, 1, 1), 2: (1, 1, 1, 1, 2), 3: (0, 0, 0, 0, 0)}
    many = [Slice(f"S{i}", f"t >= {i}", num={"v": ["nunique", "mean", "max", "min"], "c": ["nunique"]}) for i in range(70)]
    wide = R.rollup(df, "id", "P", slices=many)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    row = wide.where("id = 1").first()
    assert [row[f"P_S{i}_V_NUNIQUE"] for i in (0, 2, 3, 4, 69)] == [2, 2, 1, 0, 0]
    assert [row[f"P_S{i}_C_NUNIQUE"] for i in (0, 2, 3, 69)] == [2, 1, 0, 0]


def test_two_level_and_pivot(spark):
    df = spark.createDataFrame([(1, 1, 2.0, "x"), (1, 1, 4.0, "y"), (1, 2, 9.0, "x")], "id int, loan int, v double, s string")
    out = R.two_level(df, "id", "loan", {"PL_V": ("v", "mean")}).first()
    assert (out["PL_V_MEAN"], out["PL_V_MAX"]) == (6.0, 9.0) and out["PL_V_STD"] == pytest.approx(18**0.5)
    pivot = R.pivot_count(df, "id", "s", ["x", "y", "z"], "P", "v").first()
    assert (pivot["P_S_X"], pivot["P_S_Y"], pivot["P_S_Z"], pivot["P_V_SIZE"]) == (2, 1, 0, 3)


def test_quotes_in_category_values(spark):
    df = spark.createDataFrame([(1, "it's"), (1, "a\\b")], "id int, c string")
    out = R.rollup(df, "id", "P", categories={"c": ["it's", "a\\b"]}, cat_stats=["sum"]).first()
    assert (out["P_C_IT_S_SUM"], out["P_C_A_B_SUM"]) == (1, 1)


@pytest.mark.parametrize("hot_rows", [200_000, 1])
def test_slices_together_equal_slices_apart(large, monkeypatch, hot_rows):
    """One shuffle of the rows, and no aggregate per slice before it; hot entities go the other way."""
    monkeypatch.setattr(R, "HOT_ROWS", hot_rows)
    data = [(None if i % 50 == 0 else i % 7 if i % 3 else 1, None if i % 11 == 0 else -i % 40, float(i % 13) if i % 5 else None, "ab"[i % 2] if i % 9 else None, i % 2 if i % 17 else None, i) for i in range(3000)]
    df = large.createDataFrame([*data, (99, None, None, None, None, 9999)], "id int, t int, v double, c string, b int, tie int")
    slices = [Slice("OLD", "t < -20", count=True), Slice("NEVER", "t > 0", num={"v": ["count", "sum", "any", "std"]}, count=True)]
    slices += [Slice("LAST_2", last_k=2, order=("t", "tie")), Slice(count=True), Slice("FIRST_1", first_k=1, order=("t", "tie"), shares=False), Slice("LAST_5", last_k=5, order=("t", "tie"))]
    args = (df, "id", "P", ["v", "t"], {"c": ["a", "b", None]}, ["b"], slices)
    apart, together = R.rollup(*args), R.rollup(*args, together=True)
    assert apart.dtypes == together.dtypes
    want, got = rows(apart, "id"), rows(together, "id")
    assert len(want) == len(got) == 8
    for a, b in zip(want, got):
        assert b == tuple(x if x is None or isinstance(x, int) else pytest.approx(x, rel=1e-9, abs=1e-9) for x in a)
    plan = together._jdf.queryExecution().executedPlan().toString()
    if hot_rows > 1:
        assert plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" not in plan and "Join" not in plan
    else:
        assert "Union" in plan and "WindowGroupLimit" in plan
    assert R.rollup(*args[:6], [Slice("L", last_k=2, order=("t", "tie"), num={"v": ["nunique"]})], together=True).count() == 8
