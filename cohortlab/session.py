"""Session helpers.

The library never creates a session behind the caller's back: operators take
DataFrames. These helpers exist for tests, the bench and the query catalog.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "cohortlab",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Local session with the settings the library is tested with.

    On a cluster the caller builds its own session; what matters there is
    AQE on, UTC session zone and a shared ``spark.checkpoint.dir``.
    """
    master = master or os.environ.get("COHORTLAB_MASTER", "local[8]")
    if shuffle_partitions is None:
        shuffle_partitions = int(os.environ.get("COHORTLAB_SHUFFLE_PARTITIONS", "8"))
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.cohortlab.spreadScans", str(master.startswith("local[")).lower())
         .config("spark.driver.memory", os.environ.get("COHORTLAB_DRIVER_MEMORY", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC.

    All millisecond arithmetic (ages, label windows, hour offsets) is done on
    epoch millis of UTC wall-clock timestamps, like the oracle does.
    """
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables: the one set with
    ``setCheckpointDir``, else the one ``spark.checkpoint.dir`` names.

    If there is neither, a local master gets a private temporary folder (gone
    when the process ends). On a cluster that would be a folder of each
    machine, so it is an error.
    """
    sc = spark.sparkContext
    own = sc.getCheckpointDir()
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if own:
        # Spark makes a folder of its own for the application below the one that is set
        return named or own
    if not named:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        global _LOCAL_CKPT
        if _LOCAL_CKPT is None:
            _LOCAL_CKPT = tempfile.mkdtemp(prefix="cohortlab-ckpt-")
            atexit.register(shutil.rmtree, _LOCAL_CKPT, ignore_errors=True)
        named = _LOCAL_CKPT
    sc.setCheckpointDir(named)
    return named


_LOCAL_CKPT: str | None = None
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete tables below ``scratch_path`` before the end, when what was made
    of them has been written."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
        if p in _SCRATCH:
            _SCRATCH.remove(p)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the tables written below ``scratch_path`` by this process;
    returns how many there were. Results that are not yet computed may need
    them: call it when all of them have been written or collected."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def materialize(df):
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared
    checkpoint folder (survives executor loss; never a local checkpoint).
    Used where one intermediate result feeds several branches of a plan.
    Spark deletes it with its last reference when
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set, as
    ``build_session`` does."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
