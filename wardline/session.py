"""Spark session helpers.

The library never creates data on the driver: every function takes DataFrames
and returns DataFrames.  This module only builds a session for scripts and
tests, and resolves the shared checkpoint folder used to cut lineage in
iterative operators.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Only for local masters: executors run in the driver's JVM.
LOCAL_CONF = {"spark.driver.host": "127.0.0.1"}


def get_spark(master: str | None = None, app: str = "wardline",
              shuffle_partitions: int | None = None,
              conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library is tuned for.

    On a cluster, pass ``master=None`` and let ``spark-submit`` decide; the
    shuffle partition count should then be sized to the data (about one
    partition per 128-256 MB of shuffled bytes), AQE coalesces the rest.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        settings.update(LOCAL_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting it only when unset.

    Order: the folder already registered on the SparkContext, then the
    ``spark.checkpoint.dir`` setting of the session.  With neither, a local
    master gets a ``_checkpoints`` folder under the warehouse directory; any
    other master is refused, as a default folder would be another disk on each
    machine.  A folder that is configured is taken to be shared.
    Under Spark Connect the server owns the folder: the session setting is
    returned as is.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext on the client
        if configured:
            return configured
        raise RuntimeError("set spark.checkpoint.dir on the Spark Connect server session")
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None) or os.path.abspath("spark-warehouse")
        configured = warehouse.rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
