"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Runtime settings; safe to apply to a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


#: Bytes at which an Arrow batch to a Python worker ends.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to ``spark`` and return it. Arrow batches end at :data:`BATCH_BYTES`, if not earlier already: a
    worker holds a batch and what becomes of it as Python objects, so by rows alone long pages would make it large."""
    if int(spark.conf.get(BATCH_SETTING).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and staged tables, seen by every executor.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset, as in tests, it is a folder below the
    warehouse of a session in local mode, whose driver and executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"
