"""Writing: parquet directories, published tables, stage tables, checkpoints."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence
from pathlib import Path
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder; a cluster must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ontime-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/ontime-{label}-{uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give the context the shared folder for checkpoints, unless it has one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives lost executors and its plan starts anew."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    # One partition value may hold most rows: the rebalance hint lets adaptive execution split it over several
    # files and merge small ones, where repartition(cols) would send it to one task.
    return df.hint("rebalance", *partition_by) if partition_by else df


def _writer(df: DataFrame, partition_by: Sequence[str], mode: str) -> DataFrameWriter:
    writer = _balanced(df, partition_by).write.mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def stage_table(df: DataFrame, path: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write between two stages and go on from the written table: its size is then known to the optimizer."""
    target = path or stage_path(df.sparkSession, "stage")
    _writer(df, partition_by, "overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a folder, such as a stage table that is no longer needed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def create_exclusively(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it exists. Of several writers at once exactly one gets true.

    Needs a file system that creates exclusively, as HDFS and local disks do; some object stores do not.
    """
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = made.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getScheme() == "file":  # the JVM's local file system tests for the file before it creates it
        local = Path(made.toUri().getPath())
        local.parent.mkdir(parents=True, exist_ok=True)
        try:
            local.touch(exist_ok=False)
        except FileExistsError:
            return False
        return True
    try:
        system.create(made, False).close()
    except Py4JJavaError as error:
        if not system.exists(made):
            raise error
        return False
    return True


def _swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put folder ``new`` in the place of ``path``: two renames, and the old contents go last."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    target, fresh, old = make(path), make(new), make(f"{path.rstrip('/')}.old-{uuid4().hex}")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    had = system.exists(target)
    if had and not system.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not system.rename(fresh, target):
        if had:
            system.rename(old, target)
        raise OSError(f"cannot move {new} to {path}")
    if had:
        system.delete(old, True)


def replace_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the contents of ``path`` and return it as read back.

    The rows are written beside ``path`` and swapped in when they are complete, so ``df`` may read from ``path``, and a
    write that fails leaves the old contents as they were.
    """
    spark, schema = df.sparkSession, df.schema
    beside = f"{path.rstrip('/')}.new-{uuid4().hex}"
    _writer(df, partition_by, "errorifexists").parquet(beside)
    _swap_in(spark, beside, path)
    spark.catalog.refreshByPath(path)
    return spark.read.schema(schema).parquet(path)


def publish_predictions(df: DataFrame, path: str, partition_by: Sequence[str] = ("airport",)) -> DataFrame:
    """Replace the predictions of the airports present in ``df`` and keep all others.

    Spark swaps these partitions in when the write is complete, so ``df`` may even read from ``path``.
    """
    writer = _writer(df, partition_by, "overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_table(
    df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet", partition_by: Sequence[str] = (),
    stage_first: bool = True,
) -> DataFrame:
    """Replace a catalog table, external when ``path`` is given; other formats need their data source jar.

    An overwrite empties ``path`` before the scan: rows for a table with a path go through a stage table unless
    ``stage_first`` is false, which is safe only if ``df`` does not read from ``path``.
    """
    staged = stage_path(df.sparkSession, "stage") if path and stage_first else None
    source = stage_table(df, staged) if staged else df
    writer = _writer(source, partition_by, "overwrite").format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    if staged:
        drop_stage(df.sparkSession, staged)
    return df.sparkSession.table(name)
