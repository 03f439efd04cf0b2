"""The session that the engine expects: UTC, ANSI, adaptive execution. Cluster settings are left to the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.ansi.enabled", "true").config("spark.sql.adaptive.enabled", "true")
    builder = builder.master(master) if master else builder
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):  # noqa: ANN201
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``, which driver and executors share; where that is unset, a temporary one in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
