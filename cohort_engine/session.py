"""Session helpers.

Library code never creates its own session on a cluster; it takes the one it is
given.  ``local_session`` exists for tests and the bench script.
"""

from __future__ import annotations

import gc
import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"     # a finished query's shuffle files go at once


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cohort_engine") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("COHORT_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to a shared file system.  Only when it is
    unset and the master is local (tests, a laptop) a fresh local folder is taken;
    elsewhere executors could not see each other's files, so that is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="cohort-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    sc.setCheckpointDir(configured)
    return configured


def ship_package(spark: SparkSession) -> None:
    """Make ``cohort_engine`` importable in Python workers (the ``--py-files`` route).

    Arrow UDFs and ``mapInPandas`` functions refer to functions of this package;
    executors import them by name.  When the package is not installed on the
    executors, a zip of it is added to the context once per session.
    """
    sc = spark.sparkContext
    if getattr(sc, "_cohort_engine_shipped", False):
        return
    import zipfile

    import cohort_engine
    pkg_dir = os.path.dirname(os.path.abspath(cohort_engine.__file__))
    root = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix="cohort_engine-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._cohort_engine_shipped = True


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


@contextmanager
def files_dropped(spark: SparkSession):
    """Within it, a query's shuffle files go when the query has ended."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def drop_unreferenced(spark: SparkSession) -> None:
    """Ask for a collection, at which Spark's cleaner drops shuffle files and broadcasts that nothing refers to any more.

    The files behind a stored table stay as long as the driver holds the table's objects; a driver with memory to spare
    may not collect for half an hour, while every split of a search leaves its own."""
    gc.collect()
    spark._jvm.System.gc()
