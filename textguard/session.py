"""What the jobs need from the session: a shared work folder and checked sizes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
FEW_SPLITS = 64
TASK_ROWS = 200_000
DEALT_PARTS = 200  # Spark's spark.shuffle.sort.bypassMergeThreshold
_local_folders: dict[str, str] = {}
_scopes: list[list[str]] = []


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without that setting a local session (tests) gets a temporary folder; a
    cluster must name one, since executors cannot share a local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="textguard-")
    return _local_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    This cuts the lineage, survives lost executors, and gives the planner real
    file sizes for the steps that follow. Within ``scratch`` the table goes when
    the block ends; one to ``keep`` goes with the block around that, if there is one.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    held = _scopes[: len(_scopes) - keep]
    if held:
        held[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged in this block are deleted when it ends, apart from those to keep.

    Nothing may read them afterwards: what leaves the block must be a kept table.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.pop()
        for path in paths:
            drop_folder(spark, path)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast after counting; a longer table is left to a shuffled join."""
    return F.broadcast(df) if is_small(df, rows) else df


def spread_rows(df: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """Deal the rows of a table out to tasks of at most about so many, and to every core: short rows
    that grow much in a task, and are sorted there, come in few splits however many they are.

    Rows are dealt by their place, so they must come in the same order at each reading, as from files.
    Without a place a split is sorted before it is dealt out, and beyond ``DEALT_PARTS`` its rows are
    held and sorted as they are written. Then they are dealt out in two steps, and the second has small
    shares instead of splits.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-df.count() // rows))
    place = F.col("__place")
    dealt = df.withColumn("__place", F.monotonically_increasing_id())
    if tasks > DEALT_PARTS:
        dealt = dealt.repartitionById(DEALT_PARTS, F.pmod(place, F.lit(DEALT_PARTS)).cast("int"))
        dealt = dealt.withColumn("__place", F.xxhash64(place))
    return dealt.repartitionById(tasks, F.pmod(place, F.lit(tasks)).cast("int")).drop("__place")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core a share when a table comes in fewer splits than cores.

    Text scans are CPU bound, and a small file is one split. Tables with more
    than a few splits, that is all large ones, pass through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= min(cores, FEW_SPLITS):
        return df
    return df.repartition(cores, *keys)
