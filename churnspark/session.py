"""Session helpers: UTC clock, scratch locations on the shared checkpoint dir."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "churnspark",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job relies on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_job_settings(spark)
    return spark


def ensure_job_settings(spark: SparkSession) -> None:
    """Dates are cut from UTC instants, never from the host zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set (a shared file system).  Only when
    it is unset -- local runs and tests -- a fresh scratch folder is created.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="churnspark-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def materialize(df, name: str = "materialized"):
    """Write ``df`` once as a parquet table under the shared checkpoint
    folder and return the table read back (lineage cut).

    Used where an operator must read its input twice (a counting pass and
    an assignment pass): the input is computed ONCE (``Dataset.checkpoint``
    would compute it twice: one job to count, one to write), and both
    passes -- and any task retry after a lost executor -- read the written
    copy instead of recomputing the upstream plan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: no footer read or inference on the way back
    return spark.read.schema(df.schema).parquet(path)


@cache
def _shipped(application: str) -> None:
    home = Path(__file__).parent
    path = os.path.join(tempfile.mkdtemp(prefix="churnspark-code-"), "churnspark.zip")
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(home.rglob("*.py")):
            out.write(f, f.relative_to(home.parent))
    SparkSession.active().sparkContext.addPyFile(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors' Python workers, once per
    application, so that functions of it run wherever a task does."""
    _shipped(spark.sparkContext.applicationId)


def read_or_empty(read, empty):
    """``read()``; ``empty()`` only if its path doesn't exist.  Any other
    error -- an unreadable or damaged table -- is raised."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the checkpoint root for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/churnspark/{name}-{uuid.uuid4().hex[:12]}"
