"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# HotSpot does not compile methods above 8000 bytes. Wide feature rows reach that in one
# generated method; past the limit their expressions are generated as small methods.
HUGE_METHOD = "8000"


def small_methods(spark: SparkSession) -> None:
    """Sets that limit in a session that others have built, unless it has one of its own."""
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD)


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with this library's settings. What the caller does not name stays as the cluster has it."""
    builder = SparkSession.builder
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder.appName("shelfspark")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Only where none is named and Spark runs in this one process, a local temporary folder is set.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("Name a folder that all executors share in spark.checkpoint.dir")
        current = tempfile.mkdtemp(prefix="shelfspark-")
        context.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
