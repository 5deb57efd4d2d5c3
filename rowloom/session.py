"""Session settings, the shared scratch folder, and size checks for joins."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A fitted table with at most this many rows and bytes may be broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
#: Bytes of rows that go to a Python worker at once. Sender and worker both hold such a batch, the sender while its
#: buffers double, the worker with the batch before it.
BATCH_BYTES = 4 << 20


def session(app: str = "rowloom", master: str | None = None, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if not getattr(context, "_rowloom_shipped", False):
        home = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="rowloom-package-"), "rowloom")
        context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(home), "rowloom"))
        context._rowloom_shipped = True
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder. Where none is named a private one will do on one machine only."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rowloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder, so a lost executor costs no recomputation."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and later steps scan
    only the columns they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def dropped_shuffles(spark: SparkSession):
    """What the queries inside shuffle is deleted when each of them ends, and not when the driver collects its garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def row_batches(spark: SparkSession):
    """Arrow batches of the queries inside end by their number of rows only. For rows of a few numbers: Spark looks at
    the bytes of a batch after each row, which costs more than to send the row."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str((1 << 31) - 1))


def stored_by(df: DataFrame, key: str, name: str = "table") -> DataFrame:
    """``stored`` with the rows of a key in one bucket: joins and groupings by ``key`` read it without an exchange.

    Each bucket is one file, of the size of a shuffle partition.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = f"{re.sub('[^0-9A-Za-z]', '_', name)}_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's upper estimate of the output size; no job is run."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def bounded_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of this session end at BATCH_BYTES, or at the session's own smaller limit. Spark reads
    the limit when a query runs, so it stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < _bytes(spark.conf.get(name)) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def auto_broadcast_bytes(spark: SparkSession) -> int:
    return _bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def _bytes(text: str) -> int:
    """A size as Spark's settings write it."""
    text = text.lower().strip()
    units = {"kb": 2**10, "mb": 2**20, "gb": 2**30, "k": 2**10, "m": 2**20, "g": 2**30, "b": 1}
    for unit, factor in units.items():
        if text.endswith(unit):
            return int(float(text[: -len(unit)]) * factor)
    return int(text)


def is_planned_small(df: DataFrame) -> bool:
    """True when Spark's own size rule already broadcasts ``df``."""
    return planned_bytes(df) <= auto_broadcast_bytes(df.sparkSession)


def shared_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Mark ``df`` for broadcast only if its size is checked; tells whether it is."""
    if is_planned_small(df):
        return df, True
    fitted = df.persist()
    if fitted.limit(max_rows + 1).count() <= max_rows and planned_bytes(fitted) <= BROADCAST_BYTES:  # measured by persist
        return F.broadcast(fitted), True
    return fitted, False
