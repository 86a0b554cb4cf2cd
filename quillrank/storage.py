"""Cutting lineage on reliable storage, and checking sizes before a broadcast."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _prepare_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = tempfile.mkdtemp(prefix="quillrank-checkpoint-")
    context.setCheckpointDir(shared)


def checkpointed(df: DataFrame) -> DataFrame:
    """Run ``df`` once and read it back from the checkpoint folder from then on.

    The files outlive executors, so nothing upstream is ever recomputed.
    """
    _prepare_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame) -> DataFrame:
    """Run ``df`` once and read it back from parquet files in the checkpoint folder, which stay as checkpoints do."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def short_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside sends Python at most so many rows in a batch; the session's own setting is back afterwards.

    A batch of texts is held by the JVM, outside its heap, and by the worker at the same time.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def broadcast_if_small(df: DataFrame, width: Column, max_rows: int, max_bytes: int) -> DataFrame:
    """Hint a broadcast when ``df`` holds at most ``max_rows`` rows and ``max_bytes`` bytes.

    ``width`` is the bytes of one row. ``df`` should be checkpointed, so that what is measured is
    what is sent. Beyond either bound ``df`` comes back without a hint and joins by shuffle.
    """
    measured = (
        df.select(width.cast("bigint").alias("width"))
        .limit(max_rows + 1)
        .agg(F.count("*").alias("rows"), F.coalesce(F.sum("width"), F.lit(0)).alias("bytes"))
        .first()
    )
    if measured["rows"] <= max_rows and measured["bytes"] <= max_bytes:
        return F.broadcast(df)
    return df


# Below so many bytes per core a scan may run on fewer tasks than there are cores.
_SPREAD_BYTES = 128 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores if its estimated size is so small that its files may not be.

    A small file is one task, whatever is then done with its rows; dealing it out costs little. Larger inputs come
    in splits enough and stay where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * _SPREAD_BYTES else df


def scratch_folder(spark: SparkSession) -> str:
    """A new folder path, on the storage that checkpoints use."""
    _prepare_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}"


class Scratch:
    """A folder for intermediate tables, on the storage that checkpoints use, removed on exit.

    What leaves the ``with`` block must not read from it: checkpoint the result before.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self.folder = scratch_folder(spark)
        self._tables = 0
        self._named: list[str] = []

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        for name in self._named:
            self._spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self._spark, self.folder)

    def stored(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as parquet and read it back: lineage is cut, columns can be pruned."""
        path = self.path()
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, column: str) -> DataFrame:
        """The same as a table of as many buckets by ``column`` as shuffles have partitions.

        The planner knows how it is dealt: what groups by the column, and more, needs no shuffle. ``df`` should come
        dealt by the column, so that a task writes few files.
        """
        buckets = int(self._spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"quillrank_{uuid.uuid4().hex}"
        self._named.append(name)
        df.write.format("parquet").bucketBy(buckets, column).option("path", self.path()).saveAsTable(name)
        return self._spark.table(name)

    def path(self) -> str:
        self._tables += 1
        return f"{self.folder}/{self._tables}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder through Spark's file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
