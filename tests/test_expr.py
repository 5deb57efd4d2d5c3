import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rowloom.functions import expr as E


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "a, b, eps, expected", [(1.0, 0.0, 0, None), (0.0, 0.0, 0, None), (3.0, 2.0, 0, 1.5), (3.0, -1.0, 1, None), (None, 2.0, 0, None)]
)
def test_ratio(spark, a, b, eps, expected):
    assert one(spark, E.ratio("a", "b", eps), a=a, b=b) == expected


def test_row_statistics_skip_missing(spark):
    cols = ["a", "b", "c"]
    assert one(spark, E.row_mean(cols), a=1.0, b=None, c=4.0) == 2.5
    assert one(spark, E.row_std(cols), a=1.0, b=None, c=4.0) == pytest.approx(math.sqrt(4.5))
    assert one(spark, E.row_std(cols), a=1.0, b=None, c=None) is None
    assert one(spark, E.row_mean(cols), a=None, b=None, c=None) is None
    assert one(spark, E.row_sum(cols), a=None, b=None, c=None) == 0.0
    assert one(spark, E.row_min(cols), a=None, b=2.0, c=4.0) == 2.0
    assert one(spark, E.null_count(cols), a=None, b=2.0, c=None) == 2


def test_flags_and_clips_keep_their_null_rules(spark):
    assert one(spark, E.flag(F.col("a") > 0), a=None) == 0
    assert one(spark, E.clip_low("a"), a=None) is None
    assert one(spark, E.clip_low("a"), a=-3.0) == 0.0
    assert one(spark, E.blank_inf("a"), a=float("inf")) is None
    assert one(spark, E.blank_inf("a"), a=float("nan")) is None
    assert one(spark, E.blank_inf("a"), a=2.0) == 2.0
    assert one(spark, E.whole_years("a"), a=None) == 0
    assert one(spark, E.whole_years("a"), a=-800.0) == 2


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (25.0,), (25.1,), (100.0,), (101.0,), (None,)], "x double")
    got = [r[0] for r in df.select(E.bin_right("x", [0, 25, 50, 100])).collect()]
    assert got == [None, 0, 1, 2, None, None]


def test_cross_spells_missing_parts(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    assert rows(df.select(E.cross(["x", "y"]).alias("c")), "c") == [("a__nan",), ("nan__nan",)]
