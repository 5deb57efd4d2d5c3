import hashlib

import pytest
from pyspark.sql import functions as F

from rowloom.operators import folds


def _order(ids, seed=42):
    return sorted(ids, key=lambda i: hashlib.md5(f"{i}-{seed}".encode()).hexdigest())


@pytest.mark.parametrize("near", [4096, 3])
def test_sample_is_the_smallest_digests(spark, monkeypatch, near):
    monkeypatch.setattr(folds, "NEAR_CUT", near)
    df = spark.range(5000).withColumn("x", F.col("id") * 2)
    for n in (1, 2, 777, 4999, 5000):
        got = {r["id"] for r in folds.sample_n(df, "id", n).collect()}
        assert got == set(_order(range(5000))[:n])
    assert folds.sample_n(df, "id", 9000).count() == 5000 and folds.sample_n(df, "id", 0).count() == 0
    plan = folds.sample_n(df, "id", 777)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Exchange" not in plan and "Sort" not in plan


def test_sample_of_copies_and_of_nothing(spark):
    copies = spark.range(9000).select(F.lit(7).alias("id"))
    assert folds.sample_n(copies, "id", 10).count() == 9000  # rows that share a key stay together
    assert folds.sample_n(copies.limit(0), "id", 10).count() == 0


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_balanced_groups(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        sizes = {g: 1 + (g * g) % 37 + (400 if g == 5 else 0) for g in range(300)}
        df = spark.createDataFrame([(g,) for g, n in sizes.items() for _ in range(n)] + [(None,)], "g int")
        out = {r["g"]: (r["n"], r["fold"]) for r in folds.balanced_group_folds(df, "g", 4).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {g: n for g, (n, _) in out.items()} == sizes
    total = [sum(n for n, f in out.values() if f == k) for k in range(4)]
    assert max(total) - min(total) <= max(sizes.values())
    turn = sorted(sizes, key=lambda g: (-sizes[g], hashlib.md5(f"{g}-42".encode()).hexdigest()))
    assert [out[g][1] for g in turn] == [min(i % 8, 7 - i % 8) for i in range(300)]
