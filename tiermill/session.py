"""Session conventions.

The marts print timestamps with a literal ``Z`` and extract year/quarter, so
the session time zone must be UTC.  ANSI mode stays on: every parse that may
fail is a ``try_*`` so bad input becomes null instead of an error.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every tiermill job relies on.  They are applied to a session the
# caller hands in as well, because results depend on them.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings for throughput; a cluster deployment may override them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def ensure_conventions(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on (UTC zone, ANSI) to ``spark``."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build(master: str = "local[*]", shuffle_partitions: int | None = None,
          app_name: str = "tiermill", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with tiermill's conventions."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = {**DEFAULT_CONF, **REQUIRED_CONF}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_conventions(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and versioned tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system path
    named by the deployment), and a session without it raises: a folder of one
    machine would not be seen by the others.  On a local master a scratch
    folder is created and recorded in the session.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
        path = tempfile.mkdtemp(prefix="tiermill-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)  # for DataFrame.checkpoint()
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), *parts)
