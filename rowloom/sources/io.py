"""Scans, discovery of prediction files, and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scan(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    columns: Sequence[str] | None = None,
    missing: str = "error",
    limit: int | None = None,
    fmt: str | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Read CSV (with header) or Parquet with a declared schema.

    ``missing="empty"`` turns an absent path into an empty table; ``"error"`` raises.
    ``limit`` is the debug row cap: the rows that come first by ``order``, or any rows without one.
    """
    schema = _schema(schema)
    if not path_exists(spark, path):
        if missing != "empty":
            raise FileNotFoundError(path)
        df = spark.createDataFrame([], schema)
    elif (fmt or ("parquet" if path.endswith(".parquet") else "csv")) == "parquet":
        df = spark.read.schema(schema).parquet(path)
    else:
        df = spark.read.schema(schema).option("enforceSchema", False).csv(path, header=True)
    if columns:
        df = df.select(*columns)
    if not limit:
        return df
    return (df.orderBy(*order) if order else df).limit(limit)


def infer_csv_schema(spark: SparkSession, path: str, ids: Sequence[str] = (), sample: float = 1.0) -> T.StructType:
    """Schema of a CSV file from its values; id columns are bigint."""
    found = spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sample).schema
    return T.StructType(
        [T.StructField(f.name, T.LongType() if f.name in ids else f.dataType, True) for f in found.fields]
    )


def has_entries(spark: SparkSession, path: str) -> bool:
    """True for a folder that holds anything."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/*")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def qualified(spark: SparkSession, path: str) -> str:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def discover(
    spark: SparkSession,
    roots: Sequence[str],
    priority: Sequence[tuple[str, str]],
    anchor: str,
    at_least: int = 2,
) -> DataFrame:
    """(pref, key, file, path) of the prediction files (or output directories) found, in order
    of preference.

    ``priority`` lists (key, name). A match directly in an earlier root wins over a later root,
    which wins over one deeper below the first root. The anchor must be there, and ``at_least``
    files. Absent and empty folders are skipped.
    """
    wanted = spark.createDataFrame(
        [(i, key, file) for i, (key, file) in enumerate(priority)], "pref int, key string, file string"
    )
    homes = [qualified(spark, r) for r in roots if path_exists(spark, r) and has_entries(spark, r)]
    if not homes:
        raise FileNotFoundError(f"none of {list(roots)} holds a file")
    listings = [
        spark.read.format("binaryFile").option("recursiveFileLookup", i == 0).load(f"{home}" if i == 0 else f"{home}/*")
        for i, home in enumerate(homes)
    ]
    paths = reduce(DataFrame.union, [f.select("path") for f in listings])
    pieces = F.split("path", "/")
    steps = paths.select(pieces.alias("pieces"), F.posexplode(pieces).alias("at", "file"))
    named = steps.select(
        "file",
        F.array_join(F.slice("pieces", 1, F.col("at") + 1), "/").alias("path"),
        F.array_join(F.slice("pieces", F.lit(1), F.col("at")), "/").alias("home"),
    )
    turn = F.coalesce(*[F.when(F.col("home") == h, F.lit(i)) for i, h in enumerate(homes)], F.lit(len(homes)))
    found = (
        named.join(F.broadcast(wanted), "file")
        .groupBy("pref", "key", "file")
        .agg(F.min_by("path", F.struct(turn, "path")).alias("path"))
        .orderBy("pref")
    )
    keys = [row["key"] for row in found.select("key").collect()]
    if anchor not in keys:
        raise FileNotFoundError(f"{anchor} is missing; found {keys}")
    if len(keys) < at_least:
        raise FileNotFoundError(f"{at_least} prediction files are needed; found {keys}")
    return found


def load_wide(
    spark: SparkSession, files: Mapping[str, str], key: str = "SK_ID_CURR", value: str = "TARGET", partial: bool = False
) -> DataFrame:
    """Inner-join prediction files on the id, one column per file.

    Files that do not hold the same ids are an error, unless ``partial`` asks for the shared ids.
    """
    schema = T.StructType([T.StructField(key, T.LongType()), T.StructField(value, T.DoubleType())])
    frames = [scan(spark, path, schema).select(key, F.col(value).alias(name)) for name, path in files.items()]
    wide = reduce(lambda left, right: left.join(right, key), frames)
    if not partial:
        rows = wide.count()
        odd = {name: n for name, n in ((name, f.count()) for name, f in zip(files, frames)) if n != rows}
        if odd:
            raise ValueError(f"{rows} ids are in all files, but these hold other numbers of rows: {odd}")
    return wide


def write_reports(tables: Mapping[str, DataFrame], out_dir: str, mode: str = "error") -> dict[str, str]:
    """Write each report table as CSV beside the predictions, in a folder ``report_<name>``; gives the paths.

    Reports have a row per model, fold or pair of models, so each is one small file."""
    paths = {name: f"{out_dir.rstrip('/')}/report_{name}" for name in tables}
    for name, table in tables.items():
        table.coalesce(1).write.mode(mode).option("header", True).csv(paths[name])
    return paths


def write_predictions(df: DataFrame, path: str, fmt: str = "csv", mode: str = "error") -> str:
    """Write (id, prediction) as a directory of part files, from all executors at once."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return path
