import pytest
from conftest import rows
from pyspark.sql import functions as F

from rowloom.operators import assemble
from rowloom.plans.credit import PREDICTION_FILES
from rowloom.sources import io


def test_scan_absent_paths(spark, tmp_path):
    schema = "SK_ID_CURR BIGINT, x DOUBLE"
    assert io.scan(spark, str(tmp_path / "no.csv"), schema, missing="empty").count() == 0
    with pytest.raises(FileNotFoundError):
        io.scan(spark, str(tmp_path / "no.csv"), schema)
    (tmp_path / "a.csv").write_text("SK_ID_CURR,x\n1,2.5\n2,\n")
    found = io.infer_csv_schema(spark, str(tmp_path / "a.csv"), ["SK_ID_CURR"])
    assert rows(io.scan(spark, str(tmp_path / "a.csv"), found), "SK_ID_CURR") == [(1, 2.5), (2, None)]
    assert io.scan(spark, str(tmp_path / "a.csv"), found, columns=["x"], limit=1).columns == ["x"]


def test_discovery_order_and_guards(spark, tmp_path):
    def put(place):
        path = tmp_path / place
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("SK_ID_CURR,TARGET\n1,0.5\n")

    with pytest.raises(FileNotFoundError):
        io.discover(spark, [str(tmp_path / "none")], PREDICTION_FILES, "sub6")
    put("sub/submission4.csv")
    put("deep/er/submission3.csv")
    roots = [str(tmp_path), str(tmp_path / "sub")]
    with pytest.raises(FileNotFoundError, match="sub6"):
        io.discover(spark, roots, PREDICTION_FILES, "sub6")
    put("submission6.csv")
    put("deep/er/submission6.csv")
    (tmp_path / "empty").mkdir()
    found = io.discover(spark, [*roots, str(tmp_path / "empty")], PREDICTION_FILES, "sub6").collect()
    assert [r["key"] for r in found] == ["sub6", "sub4", "sub3"]
    assert found[0]["path"].endswith(f"{tmp_path.name}/submission6.csv")


def test_wide_load_is_an_inner_join(spark, tmp_path):
    a = spark.createDataFrame([(1, 0.1), (2, 0.2)], "SK_ID_CURR long, TARGET double")
    b = spark.createDataFrame([(2, 0.4), (3, 0.6)], "SK_ID_CURR long, TARGET double")
    files = {n: io.write_predictions(df, str(tmp_path / n)) for n, df in (("a", a), ("b", b))}
    with pytest.raises(ValueError, match="'a': 2"):
        io.load_wide(spark, files)
    assert rows(io.load_wide(spark, files, partial=True), "SK_ID_CURR") == [(2, 0.2, 0.4)]
    assert rows(io.load_wide(spark, {"a": files["a"], "c": files["a"]}), "SK_ID_CURR") == [(1, 0.1, 0.1), (2, 0.2, 0.2)]
    check = assemble.align_check(a, b, "SK_ID_CURR").first()
    assert (check["n_left"], check["n_right"], check["n_joined"], check["aligned"]) == (2, 2, 1, 0)


def test_union_fills_missing_columns(spark):
    a, b = spark.range(1).select("id", F.lit(1).alias("x")), spark.range(1).select("id")
    assert sorted(r["x"] or 0 for r in assemble.union_by_name(a, b).collect()) == [0, 1]
