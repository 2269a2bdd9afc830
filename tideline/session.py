"""Session set-up and the few settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Event-time arithmetic on TIMESTAMP_NTZ goes through TIMESTAMP; UTC makes that exact.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Past checkpoints that a stream keeps for recovery.
    "spark.sql.streaming.minBatchesToRetain": "3",
}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, app: str = "tideline", partitions: int | None = None) -> SparkSession:
    """A single-JVM session for tests and benchmarks. On a cluster, pass your own to `configure`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def ignore_idle_sources(spark: SparkSession, ignore: bool = True) -> None:
    """Let the fastest of several sources set the watermark, so that an idle one does not hold it back.

    An approximation of a per-source idle timeout: rows of a slow source may then count as late.
    """
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max" if ignore else "min")
