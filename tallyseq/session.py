"""Session helpers: a local session for tests and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the session comes from outside."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyseq")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Paths given out and not yet deleted, oldest first.
_given: list[str] = []


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder named by spark.checkpoint.dir, which every executor sees.

    Only a local master without that setting gets a temporary folder; a cluster raises, since its
    executors would each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tallyseq-")
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/tallyseq/{label}-{uuid.uuid4().hex}"
    _given.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage ends there,
    so a lost executor costs a re-read and not a recomputation."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.shared_path = path
    return table


#: Rows that a task sorts, joins or sums at once, where their number is known beforehand.
TASK_ROWS = 1 << 20


def dealt(df: DataFrame, rows: int, *keys: str, most: int = TASK_ROWS) -> DataFrame:
    """df by the hash of its keys in so many partitions that `rows` rows in all give about `most` to each.

    A fixed number of partitions, or tasks joined until they are as many as the cores, would let the memory of
    a task grow with the input; here the number of tasks grows.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // most)), *keys)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the tables made inside at the end, but for those passed to the function it gives.

    What leaves the block must be such a kept table: a plan over a deleted one can't run.
    """
    start, kept = len(_given), set()

    def keep(table: DataFrame) -> DataFrame:
        kept.add(table.shared_path)
        return table

    try:
        yield keep
    finally:
        for path in [p for p in _given[start:] if p not in kept]:
            delete(spark, path)
        _given[start:] = [p for p in _given[start:] if p in kept]
