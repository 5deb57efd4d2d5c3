from rowloom.operators import schema


def test_clean_names_suffixes_collisions(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a b` int, `a--b` int, `_A b_` int")
    assert schema.clean_names(df).columns == ["A_B", "A_B_2", "A_B_3"]
    assert schema.clean_name("x (y)%z", upper=False) == "x_y_z"


def test_binary_narrow_constant(spark):
    df = spark.createDataFrame(
        [(1, 0, None, 5, 300, None), (2, 1, None, 5, -40000, 1)],
        "id int, flag int, nothing int, same int, wide int, gap int",
    )
    assert schema.binary_columns(df) == ["flag", "nothing", "gap"]
    assert schema.constant_columns(df) == ["nothing", "same"]
    kinds = dict(schema.narrow(df, keep=["id"]).dtypes)
    assert kinds == {"id": "bigint", "flag": "tinyint", "nothing": "int", "same": "tinyint", "wide": "int", "gap": "tinyint"}


def test_align_keeps_shared_columns_in_left_order(spark):
    a, b = spark.createDataFrame([(1, 2, 3)], "x int, y int, z int"), spark.createDataFrame([(1, 2)], "z int, x int")
    left, right = schema.align(a, b)
    assert left.columns == right.columns == ["x", "z"]
