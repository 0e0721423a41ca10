"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "ledgerwatch", master: str | None = None,
                  **conf: str) -> SparkSession:
    """A session with UTC event time, adaptive execution and RocksDB state.

    Shuffle partitions are left to the cluster's own setting; pass
    ``{"spark.sql.shuffle.partitions": n}`` through ``conf`` to change it.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state."
                "RocksDBStateStoreProvider")
        .config("spark.sql.streaming.stateStore.rocksdb."
                "changelogCheckpointing.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Windows and epoch conversions are defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for state and staged tables that every executor can reach.

    The parent is the cluster's ``spark.checkpoint.dir``. Only a session whose executors
    are threads of the driver (``local[...]``) may leave it out, as in tests, and gets a
    temporary folder; any other master must set it.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a shared folder")
        base = tempfile.mkdtemp(prefix="ledgerwatch-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
