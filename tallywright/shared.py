"""Where a job may keep intermediate data."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Whether Spark deletes the shuffle files of a job when the job is over.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders that `stage` has written inside the innermost `staging`.
_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)

# Numbers the rows of a staged table; written with them, so every later read sees the same ones.
ROW = "_row"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; only a local session may fall back to its own disk."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="tallywright-")
        spark.conf.set(CHECKPOINT_SETTING, folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session setting `name` is `value` inside, and what it was before again after that."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables that `stage` writes inside are deleted at the end; what is returned must not read them."""
    outer = _written.set([])
    try:
        yield
    finally:
        folders = _written.get()
        _written.reset(outer)
        for folder in folders:
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_parquet(df: DataFrame, folder: str, *partition_by: str, dictionary: bool = True) -> None:
    """Write `df` in little room: well compressed, and without the job's shuffle files once it is there."""
    writer = df.write.option("compression", "zstd")
    writer = writer if dictionary else writer.option("parquet.enable.dictionary", "false")
    with setting(df.sparkSession, CLEANUP_SETTING, "true"):
        writer.parquet(folder, partitionBy=list(partition_by) or None)


def stage(df: DataFrame, label: str, *partition_by: str, dictionary: bool = True) -> DataFrame:
    """Write `df` once to the shared folder and go on from there.

    For results that several steps read: they get column pruning on the written table, and none of
    them repeats the work or depends on the executors that did it. Without a `dictionary`, values that are
    mostly different take less time to write. Inside `staging` the table lasts until its end.
    """
    folder = scratch_folder(df.sparkSession, label)
    if (written := _written.get()) is not None:
        written.append(folder)
    write_parquet(df, folder, *partition_by, dictionary=dictionary)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def stage_numbered(df: DataFrame, label: str) -> DataFrame:
    """`stage`, with a number for every row that does not depend on how the table is read later."""
    return stage(df.withColumn(ROW, F.monotonically_increasing_id()), label, dictionary=False)
