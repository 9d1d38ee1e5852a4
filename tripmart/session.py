"""Spark session factory and the cluster facts the operators read from it."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


class NoSharedFolder(RuntimeError):
    """A cluster names no folder that its executors share."""


def create(app: str = "tripmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on: UTC, ANSI casts, adaptive execution.

    Without a master, here or where the job is submitted, it runs on the cores of this machine; only there the number of
    shuffle partitions is set, a cluster's own stands.
    """
    cores = os.environ.get("BENCH_CPUS", "8")
    submitted = master or _submitted_master()
    settings = {
        "spark.app.name": app,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if not submitted or submitted.startswith("local"):
        settings |= {
            "spark.master": submitted or f"local[{cores}]", "spark.sql.shuffle.partitions": cores,
            "spark.driver.memory": os.environ.get("TRIPMART_DRIVER_MEMORY", "8g")
        }
    else:
        settings["spark.master"] = submitted
    settings.update(conf)
    return SparkSession.builder.config(map=settings).getOrCreate()


def _submitted_master() -> str | None:
    """The master a submitted job was given, before its session is made."""
    found = re.search(r"--master[ =](\S+)", os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    return found[1] if found else None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset and all runs on this machine
    (tests, local runs) a folder of the machine is made and set, and removed when the program ends.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    context = spark.sparkContext._jsc.sc()
    if named:
        if not context.getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(named)
        return named
    if context.getCheckpointDir().isDefined():
        return context.getCheckpointDir().get()
    if not spark.sparkContext.master.startswith("local"):
        raise NoSharedFolder("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="tripmart-checkpoint-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(own)
    return own


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder, so a lost executor costs no recomputation from the start."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
