"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "docket", cpus: str | int = 8, partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own settings."""
    scratch = tempfile.mkdtemp(prefix="docket-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DOCKET_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def working_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    It is the folder the cluster names in ``spark.checkpoint.dir``. A folder of
    our own is made only in local mode, where driver and executors share a disk.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = named or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="docket-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


_made: list[tuple[str, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, noted for :func:`cleared`."""
    path = f"{working_dir(spark).rstrip('/')}/docket-{name}-{uuid.uuid4().hex[:12]}"
    _made.append((spark.sparkContext.applicationId, path))
    return path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders that this session has made below the shared folder."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        if (spark.sparkContext.applicationId, path) not in _made:
            raise ValueError(f"not made by this session: {path}")
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
        _made.remove((spark.sparkContext.applicationId, path))


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside the block when it ends.

    What leaves the block must not read them: a job returns what it has written or
    collected.
    """
    before = len(_made)
    try:
        yield
    finally:
        discard(spark, *[path for _, path in _made[before:]])


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Iterative jobs read such a table many times. Its plan is one scan, with column
    pruning, and a lost executor costs a re-read and not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=partition_by)
    names = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*names)


#: Partitions of few rows, until there are so many of them; then partitions of many rows.
FEW_ROWS, FEW_PARTITIONS, MANY_ROWS = 20_000, 12, 250_000


def partitions_of(rows: int) -> int:
    """The number of partitions of a learner's rows; it depends on the rows alone.

    In every pass each partition sends a learner one table of statistics for each open node, and as many partitions
    receive them, so what is sent grows with the partitions and not with their rows.
    """
    return max(1, min(FEW_PARTITIONS, -(-rows // FEW_ROWS)), -(-rows // MANY_ROWS))


def by_key(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """Partitions that depend on the rows alone, each in the order of the key.

    Spark's tree learners sample and add up by partition. With the number of partitions taken
    from the row count and rows dealt by key hash, a model does not change with the
    cores, the files or the size of the splits.
    """
    return df.repartition(partitions_of(rows), *key).sortWithinPartitions(*key)


def side_by_side(spark: SparkSession, threads: int, rows: int) -> int:
    """How many of ``threads`` learners of so many rows each run at a time: enough to keep every core busy.

    A learner keeps its rows and their draws for each tree in memory while it runs.
    """
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(threads, -(-3 * cores // partitions_of(rows))))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, for a cluster where it is not installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # Executors fetch the file from the driver later on, so it stays until the driver ends.
    folder = tempfile.mkdtemp(prefix="docket-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "docket.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for at, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(at, name)
                    out.write(file, os.path.join("docket", os.path.relpath(file, root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


_shipped: set[str] = set()
