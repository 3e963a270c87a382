"""Session helpers: a local session for tests and the bench, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so that dates and hours do not depend on the host, AQE for
# runtime coalescing, skew-join splitting and broadcast conversion based on measured sizes.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast only what AQE has measured at run time, never on plan-time estimates
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "txnguard",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench; a cluster job passes its own session."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**CORE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    return spark


# Starting point for a large cluster (about 100 TB of input, 1000 executors). Shuffle partitions
# are set high and AQE coalesces them to the advisory size at run time; skewed join partitions
# are split; broadcast is decided by AQE from measured sizes only; scans read 256 MB splits.
CLUSTER_CONF = {
    **{k: v for k, v in CORE_CONF.items()},
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def apply_core_conf(spark: SparkSession) -> None:
    """Pin the runtime settings the library depends on (safe on an existing session)."""
    for k, v in CORE_CONF.items():
        if k.startswith("spark.sql.streaming.stateStore"):
            continue  # static for a running session; set at build time
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and lineage-cutting tables.

    On a cluster this is whatever `spark.checkpoint.dir` names. Only when it is unset (tests,
    local runs) do we create a scratch folder and register it.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="txnguard-ckpt-")
        sc.setCheckpointDir(d)
    return d

