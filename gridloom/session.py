"""Session settings the library relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Timestamps are instants; every rendering, truncation and date partition is UTC.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state beside the heap, so that it may outgrow an executor's memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # The default INT96 has no statistics, so time ranges would not reach the reader.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Only settable before a session starts: wide plans compile more classes than the default keeps.
STATIC_SETTINGS = {"spark.sql.codegen.cache.maxEntries": "2000"}


def build_session(app_name: str = "gridloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; ``master`` only for local use."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = (
            builder.master(master)
            .config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.bindAddress", "127.0.0.1")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the same settings on a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below the cluster's shared folder, for tables and stream state.

    The cluster names the folder in ``spark.checkpoint.dir``. Where that is unset, a session on one
    machine gets a temporary folder; on a cluster, executors would not see one, so that is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="gridloom-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"
