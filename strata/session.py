"""Session helpers: a tuned local/cluster session and a shared scratch folder.

Scratch data always goes under ``spark.checkpoint.dir`` (the shared folder a
cluster names there).  Only when that setting is absent and the master is
local, as in tests, do we create a local folder and register it; on a cluster
its absence is an error, for other machines would not see such a folder.

Functions that run in Python workers are imported there by name, so the package
is shipped with the session (or give its zip to ``--py-files``).
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for a session this library builds itself (tests, bench).  Library
# functions never change confs of a session they are handed.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Static (estimate-based) broadcasts are off: the merge broadcasts a side
    # only after measuring it (plans/sizing.py).  AQE may still turn a join
    # into a broadcast from *measured* shuffle sizes at run time.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128MB",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the session's Python workers, wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="strata-pkg-"), "strata")
    archive = shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``; set a local one only when unset, and
    only for a local master."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session has no SparkContext
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return d
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "strata-scratch", f"{name}-{uuid.uuid4().hex[:12]}")
