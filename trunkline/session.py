"""Spark session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Runtime settings the operators rely on; a session may override any of them.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    app_name: str = "trunkline", cores: int | str = "*", **settings: str
) -> SparkSession:
    """A local session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path below ``spark.checkpoint.dir``, which every node can reach.

    A machine-local temporary folder serves only sessions whose master is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all nodes")
        root = tempfile.mkdtemp(prefix="trunkline-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
