"""A session with the settings that the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "logweir", master: str | None = None, **settings: str) -> SparkSession:
    """Adaptive plans, UTC, RocksDB for streaming state. settings override, with underscores for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    for key, value in (base | {k.replace("_", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
