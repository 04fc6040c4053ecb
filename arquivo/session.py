"""Spark session helpers.

Cluster jobs take their settings from the session they are given; the builder
here is for tests, benches and local use. ``spark.checkpoint.dir`` is only set
when the cluster has not named one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package is written against. AQE re-plans joins
# and coalesces small shuffle partitions at run time; skew-join splits a hot
# join key across tasks instead of sending it to one.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what has a proven size: the fixed registry (explicit
    # hint) or a join side measured at run time by AQE. No broadcast is
    # chosen from file-size estimates.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "arquivo",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for streaming progress: ``spark.checkpoint.dir``.

    A session on a local master that has none (tests) gets a temporary folder; any other
    raises, as executors and a restarted driver would not find each other's files there.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="arquivo-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder."""
    return os.path.join(checkpoint_dir(spark), name)
