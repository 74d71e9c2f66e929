"""Carries this package to the executors; the folder they share with the driver."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


BATCH_KEY, BATCH_MB = "spark.sql.execution.arrow.maxBytesPerBatch", 8


def small_batches(spark: SparkSession, mb: int = BATCH_MB) -> None:
    """Has rows go to Python and back in batches of ``mb``, unless the session asks for
    smaller ones: a batch is held by both sides, several times over."""
    now = spark.conf.get(BATCH_KEY).lower()
    size = int(now.rstrip("bkmg") or 0) * {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now.rstrip("b")[-1:], 1)
    if not 0 < size <= mb << 20:
        spark.conf.set(BATCH_KEY, f"{mb}m")


@contextmanager
def smaller_batches(spark: SparkSession, mb: int) -> Iterator[None]:
    """While it lasts: for what runs two Python workers to a task on rows of megabytes."""
    before = spark.conf.get(BATCH_KEY)
    small_batches(spark, mb)
    try:
        yield
    finally:
        spark.conf.set(BATCH_KEY, before)


def ship(spark: SparkSession) -> None:
    """Adds a ZIP of the package to the context once, so that Python workers find it
    whether or not it is installed where they run, and bounds what they get at a time."""
    small_batches(spark)
    context = spark.sparkContext
    if getattr(context, "_telestream", False):
        return
    home = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(), "telestream.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, f"{home.name}/{p.relative_to(home)}")
    context.addPyFile(path)
    context._telestream = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``. Where it
    is unset a folder of this machine does, if all runs on this machine, and only then."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file:/tmp/checkpoints/telestream"
    return found.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """The rows over as many partitions as there are cores, where a small file would leave
    costly work per row to one of them; large tables have more partitions and stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The table, written under the shared folder and read again, so that what follows does
    not compute it twice and a lost executor costs no more than its own tasks. Removed when
    the driver's Python ends."""
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the JVM may have ended before Python does
        pass
