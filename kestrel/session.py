"""Session and shared-folder helpers."""

from __future__ import annotations

import gc
import os
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "kestrel") -> SparkSession:
    """Session used by tests and the bench.  On a cluster the submitter's
    own session is used and none of these settings are imposed."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always used when present.  Only a local master
    without it (tests) gets a private folder; on a cluster executors would
    each write to their own disk, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


#: Paths given out to this thread within ``scratch_discarded``.
_SCRATCH = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables.

    It is deleted when the application ends.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/kestrel-{name}-{uuid.uuid4().hex[:12]}"
    getattr(_SCRATCH, "paths", []).append(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder named as Spark names it."""
    from pyarrow import fs

    uri = uri.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table written below a ``scratch_path`` that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def scratch_discarded(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread writes below a ``scratch_path`` meanwhile are deleted at the end: what is kept must not read them."""
    before, _SCRATCH.paths = getattr(_SCRATCH, "paths", []), []
    try:
        yield
    finally:
        paths, _SCRATCH.paths = _SCRATCH.paths, before
        for path in paths:
            discard(spark, path)


#: Drops the shuffle files of a SQL execution when it ends, not when the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITERS, _WRITERS_LOCK = [0, "false"], threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes begun meanwhile leave no shuffle files behind.  The session has its own setting again when the last of the threads leaves."""
    with _WRITERS_LOCK:
        if not _WRITERS[0]:
            _WRITERS[1] = spark.conf.get(DROP_SHUFFLES, "false")
            spark.conf.set(DROP_SHUFFLES, "true")
        _WRITERS[0] += 1
    try:
        yield
    finally:
        with _WRITERS_LOCK:
            _WRITERS[0] -= 1
            if not _WRITERS[0]:
                spark.conf.set(DROP_SHUFFLES, _WRITERS[1])


def collect_garbage(spark: SparkSession) -> None:
    """Shuffle files and cached blocks of RDDs that nothing refers to any more go now; a driver with a large heap seldom collects."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df):
    """Materialise ``df`` into the shared checkpoint folder (reliable
    checkpoint, survives executor loss) and return the re-read frame."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df, name: str):
    """``df`` written as Parquet below the shared folder and read back: for rows that are read several times.

    Columns are encoded and pruned, which a checkpoint's rows are not; what is on disk is a fraction of them.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


Result = TypeVar("Result")


def concurrently(spark: SparkSession, jobs: Sequence[Callable[[], Result]], parallelism: int = 4) -> list[Result]:
    """Results of independent jobs in order, ``parallelism`` of them at a time.

    Small jobs leave most of a cluster idle between their stages; large ones share it.  Each job must finish its own
    Spark work, or only its planning runs here."""
    run = inheritable_thread_target(spark)
    if parallelism <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        return pool.map(lambda job: job(), [run(job) for job in jobs], chunksize=1)
