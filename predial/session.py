"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from predial.contracts import ContractError

SETTINGS = {
    # Strict casts must fail, lenient ones use try_*.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    # A period run replaces its own folder only, and `2026_1` stays text.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Runtime splitting of hot join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "predial") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    return configure(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A private temporary folder is used only in local mode, where driver and
    executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ContractError("spark.checkpoint.dir is not set: name a shared folder in it")
    root = tempfile.mkdtemp(prefix="predial-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{scratch_root(spark)}/predial/{label}-{uuid.uuid4().hex}"
