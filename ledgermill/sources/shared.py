"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


_folder_choice = Lock()
# Folders of local applications that go without the setting, which cannot be changed once a session runs.
_own_folders: dict[str, str] = {}
# Tables of each running job. A job's name is a property of its thread, which threads that it starts take over.
_JOB = "ledgermill.job"
_kept: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder of the cluster's `spark.checkpoint.dir`. Only a session on one machine may go without it."""
    with _folder_choice:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder:
            return folder.rstrip("/")
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors can reach")
        application = spark.sparkContext.applicationId
        if application not in _own_folders:
            _own_folders[application] = tempfile.mkdtemp(prefix="ledgermill-")
        return _own_folders[application]


def materialise(df: DataFrame, outlives: bool = False) -> DataFrame:
    """Write `df` once and go on from the written table.

    Cuts the lineage in a way that survives lost executors, fixes values that depend on partitioning, and gives the
    planner the true size of what follows. A table that `outlives` stays when the innermost `removing_tables` ends.
    """
    path = f"{shared_folder(df.sparkSession)}/ledgermill-{uuid.uuid4().hex}"
    jobs = (df.sparkSession.sparkContext.getLocalProperty(_JOB) or "").split()
    for job in jobs[:-1] if outlives else jobs:
        if job in _kept:
            _kept[job].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def removing_tables(spark: SparkSession):
    """Remove the tables that `materialise` writes inside, at the end, when a job has written its outputs.

    Only tables of this job: of this thread and of those that it starts by `side_by_side`.
    """
    context, job = spark.sparkContext, uuid.uuid4().hex
    around = context.getLocalProperty(_JOB)
    _kept[job] = []
    context.setLocalProperty(_JOB, f"{around} {job}" if around else job)
    try:
        yield
    finally:
        context.setLocalProperty(_JOB, around)
        settings = context._jsc.hadoopConfiguration()
        for path in _kept.pop(job):
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(settings).delete(place, True)


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleanup = Lock()
# Writers in each session that want its shuffles removed, and what the session had set before them.
_cleaning: dict[int, tuple[int, str | None]] = {}


@contextmanager
def dropping_shuffles(spark: SparkSession):
    """Shuffle files of executions that end inside go at once, not when the driver's JVM collects their plans, which may
    be never in a job that makes little garbage there. The setting belongs to the session, whose threads may overlap here.
    """
    session = spark._jsparkSession.hashCode()
    with _cleanup:
        writers, before = _cleaning.get(session) or (0, spark.conf.get(_SHUFFLE_CLEANUP, None))
        _cleaning[session] = (writers + 1, before)
        spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _cleanup:
            writers, before = _cleaning.pop(session)
            if writers > 1:
                _cleaning[session] = (writers - 1, before)
            elif before is None:
                spark.conf.unset(_SHUFFLE_CLEANUP)
            else:
                spark.conf.set(_SHUFFLE_CLEANUP, before)


def spread(df: DataFrame) -> DataFrame:
    """Share out a table that arrives in fewer splits than there are cores, such as one file that cannot be split.

    Tables of many splits are returned as they are, so large ones are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def gathered(df: DataFrame, task_bytes: int = 128 << 20) -> DataFrame:
    """Put the splits of a table of files together where they are small and many more than the cores, since each task costs
    some time and, if it writes, a file. A split's rows stay together and in order.
    """
    spark = df.sparkSession
    splits = df.rdd.getNumPartitions()
    together = max(1, task_bytes // spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-splits // together))
    return df if splits <= tasks else df.coalesce(tasks)


def side_by_side(*jobs: Callable, at_once: int | None = None) -> list:
    """Run independent jobs at the same time, so that one's last tasks do not leave the executors idle.

    Each job gets its own copy of the caller's job group and scheduler pool.
    """
    session = SparkSession.active()
    with ThreadPoolExecutor(at_once or max(1, len(jobs))) as pool:
        running = [pool.submit(inheritable_thread_target(session)(job)) for job in jobs]
        return [future.result() for future in running]
