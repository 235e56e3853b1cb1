"""Session helpers: one place for the Spark settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the library's semantics depend on. They are runtime SQL confs, so
# they can also be applied to a session someone else built (``apply_conf``).
REQUIRED_CONF = {
    # Python's json.loads keeps the last of duplicate keys; Spark's VARIANT
    # parser rejects them unless this is on (then it keeps the last one).
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Settings for performance at scale; a cluster may already set its own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints (hot-key chunks, routed JSONL lines) can be large; remove
    # them from the shared folder once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "dialogprep",
    extra: dict | None = None,
) -> SparkSession:
    """Build (or fetch) a session with the library's settings.

    On a cluster pass ``master=None`` and let spark-submit decide. The Spark
    UI stays off: the library never needs it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", **DEFAULT_CONF, **REQUIRED_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset a
    local master (tests) gets a scratch folder of its own; a cluster, whose
    executors would each write to their own disk, is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="dialogprep-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
