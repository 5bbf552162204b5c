"""Spark session and shared-folder helpers.

Nothing here is specific to local mode: on a cluster the session comes
from the launcher and these helpers only read its settings.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def spark_session(cpus: int | str | None = None, app: str = "bibspark",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local session used by tests and the bench (a cluster passes its own)."""
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BIBSPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call sites of column expressions cost several round trips each: most of the time to build all rules' plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # code lists are a few KB; anything bigger must go through a shuffle join
        .config("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only a local session (tests) may leave it unset; it
    gets a fresh scratch folder.  On a cluster a folder of the driver's machine
    would be no shared one, so an unset value is an error there.
    """
    conf = spark.sparkContext.getConf()
    path = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        path = tempfile.mkdtemp(prefix="bibspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def compiled(spark: SparkSession) -> None:
    """Let no generated method grow beyond what HotSpot compiles (8,000 bytes), unless the session says otherwise.

    Spark joins the steps of a stage into one method of up to 64 kB, and HotSpot interprets every method over
    8,000 bytes for ever; beyond this limit Spark runs the steps one by one, each in methods that get compiled.

    An aggregate over rows that are sorted by its keys takes them as they come: Spark's hash aggregate of lists
    keeps 128 groups and then sorts all rows, before and after the merge.
    """
    for key, value in (("spark.sql.codegen.hugeMethodLimit", "8000"), ("spark.sql.execution.replaceHashWithSortAgg", "true")):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes within go as soon as a write is done: else they stay on the disks, beside those of all
    that follows, until the driver happens to collect garbage.  A task that still asks for them makes its stage run again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def many_parts(spark: SparkSession) -> int:
    """Parts for a shuffle whose rows are sorted: 64 for each core, or the session's number if that is more, so that
    a task's rows mostly fit into memory and are not spilled."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 64 * spark.sparkContext.defaultParallelism)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder (one per call)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"

