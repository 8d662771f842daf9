"""Session construction and the shared scratch location.

On a cluster the session is created by the platform and ``spark.checkpoint.dir``
names a shared folder; ``scratch_dir`` reads it from the session.  Only a local
master may leave it unset (tests, benches) and then gets a fresh local folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "lumen", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches (a cluster brings its own)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder.  Raises on a cluster without one:
    a machine-local folder would hide each executor's files from the others."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    master = spark.sparkContext.master
    if not re.match(r"local(\[[^]]*\])?$", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master {master})")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="lumen-scratch-")
    return _LOCAL[app]


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A new, unique folder under the application's scratch in the checkpoint folder."""
    return f"{_scratch_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/lumen-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application's operators wrote in the checkpoint folder.
    Results read from it must have been consumed or saved."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
