"""Session defaults for running the library.

On a cluster the submitter's settings win: nothing here overrides a value that
is already set on the session, it only fills in what a local run needs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app_name: str = "ticketgrain", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach for staged tables and checkpoints.

    ``spark.checkpoint.dir`` is what the cluster names.  Only when no checkpoint
    folder is known at all (local tests) a fresh temporary one is made.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if named:
        if not current.isDefined():
            sc.setCheckpointDir(named)
        return named
    if current.isDefined():
        return current.get()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ticketgrain-"))
    return sc._jsc.sc().getCheckpointDir().get()


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/ticketgrain-{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Delete the staged tables and files this process has made; call it when their readers are done."""
    while _SCRATCH:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
