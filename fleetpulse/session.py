"""Session settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Times are UTC throughout; partitions of the stored tables are UTC hours.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}
# Sizes are left to the cluster. Adaptive execution merges small shuffle partitions, splits
# skewed ones and picks joins from measured sizes; sessions merge before they are exchanged.
ADVISED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A day of de-duplication keys belongs on local disk, not in the executor's heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A micro-batch stores the keys it changed, not a snapshot of every state partition.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


# Of these, what the streaming plans rely on whatever the cluster's defaults.
STREAMING = {key: value for key, value in ADVISED.items() if key.startswith("spark.sql.streaming.")}


def prepare(spark: SparkSession) -> SparkSession:
    """Applies the settings that results and streaming plans depend on to an existing session."""
    for key, value in {**REQUIRED, **STREAMING}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", name: str = "fleetpulse", memory: str = "4g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**REQUIRED, **ADVISED}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
