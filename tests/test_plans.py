"""Plans of wide rollups, the model matrix, and whole pipelines at small settings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.operators import rollup, select
from rowloom.operators.rollup import Slice
from rowloom.plans import train
from rowloom.plans.catalog.presets import credit_tables
from rowloom.plans.matrix import model_matrix
from conftest import SMALL


def test_a_wide_rollup_reads_and_shuffles_its_table_once(large, tmp_path):
    df = large.range(1000).select((F.col("id") % 50).alias("k"), *[(F.col("id") * i).alias(f"c{i}") for i in range(40)])
    df.write.parquet(str(tmp_path / "t"))
    child = large.read.parquet(str(tmp_path / "t"))
    slices = [Slice(), *[Slice(f"S{i}", f"c1 > {i * 100}") for i in range(4)]]
    wide = rollup.rollup(child, "k", "P", [f"c{i}" for i in range(40)], slices=slices)
    assert len(wide.columns) > 900
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    ranked = rollup.rollup(child, "k", "P", [f"c{i}" for i in range(40)], slices=[*slices, Slice("L", last_k=3, order=("c1",))])
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # the last three are cut out before their shuffle
    one = wide.where("k = 7").select("P_C3_SUM", "P_S1_C3_MEAN").first()
    own = [i for i in range(1000) if i % 50 == 7]
    assert one[0] == sum(i * 3 for i in own) and one[1] == np.mean([i * 3 for i in own if i > 100])


def test_shares_in_long_form(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, "b"), (None, "a")], "k int, c string")
    got = {(r.k, r.value): r.share for r in rollup.share_rows(df, "k", ["c"]).collect()}
    assert got == {(1, "a"): pytest.approx(2 / 3), (1, None): pytest.approx(1 / 3), (2, "b"): 1.0}


def test_correlations_across_blocks_use_all_rows(spark, monkeypatch):
    monkeypatch.setattr(select, "BLOCK", 2)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 5))
    x[:, 4] = x[:, 0] + 0.1 * x[:, 4]
    x[rng.random(x.shape) < 0.1] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"c{i} double" for i in range(5))).repartition(7)
    got = {(r.i, r.j): r.r for r in select.pair_correlations(df, [f"c{i}" for i in range(5)]).collect()}
    assert len(got) == 10
    for (i, j), r in got.items():
        ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert r == pytest.approx(np.corrcoef(x[ok, i], x[ok, j])[0, 1])


def test_the_matrix_keeps_the_order_of_columns(spark):
    df = spark.createDataFrame([(i, i % 2, "abcd"[i % 4], float(i % 4), float(i * i % 7), 1.0) for i in range(40)], "id long, y int, t string, n double, m double, one double")
    built = model_matrix(df, "id", "y")
    assert built.features == ["t", "m"]  # n repeats the code of t, which comes first
    assert built.categorical == ["t"] and built.frame.columns == ["id", "y", "t", "m"]
    with pytest.raises(ValueError, match="neither numbers nor text"):
        model_matrix(df.withColumn("day", F.current_date()), "id", "y")


@pytest.mark.parametrize("generation", ["2", "5"])
def test_a_whole_run(spark, generation):
    s = train.Settings(folds=2, trees=2, knn=(5,), max_features=30)
    result = train.run(credit_tables(spark, SMALL), generation, s)
    scored = result.predictions.collect()
    assert scored and all(0 <= r[1] <= 1 for r in scored) and 0 <= result.oof_auc <= 1
    assert {r.model for r in result.reports["auc"].collect()} == set(result.weights)
    assert sum(result.weights.values()) == pytest.approx(1)
    if generation == "5":
        assert any(c.endswith("_PRED") for c in result.features) or len(result.features) <= 30


def test_instalments_are_read_once_and_meet_their_applicant_before_any_aggregate(large):
    """Generations 1v2 and 4: rows that come out of a join are stored, and no aggregate of all slices is shuffled."""
    from rowloom.plans import credit
    from rowloom.plans.catalog.presets import credit_tables

    from conftest import SMALL

    child = credit_tables(large, SMALL)["installments"]
    for generation in ("1v2", "4"):
        out = credit.child_features(child, "installments", generation)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
        assert plan.rindex("Aggregate") < plan.index("Exchange hashpartitioning")  # plans show the last step first
