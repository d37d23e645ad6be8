"""Intermediate tables in the shared folder.

A job that reads a result several times writes it once here instead of caching it:
the files outlive lost executors, cut the lineage, and later passes read only the
columns they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from predial.session import scratch_folder
from predial.sinks.folders import Folders
from predial.sinks.leases import Lease


class Stage:
    """A private folder, removed at the end of the `with` block.

    Inside the block it holds a lease; what killed runs left beside it goes when theirs is over.
    """

    def __init__(self, spark: SparkSession, label: str = "stage"):
        self.spark = spark
        self.folder = scratch_folder(spark, label)
        self.lease: Lease | None = None

    @classmethod
    def at(cls, spark: SparkSession, folder: str) -> Stage:
        """A stage over a folder that may be there already."""
        stage = cls(spark)
        stage.folder = folder
        return stage

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        Folders(self.spark, self.folder).remove(self.folder)

    def __enter__(self) -> Stage:
        self.lease = Lease(self.spark, self.folder)
        self.lease.sweep(self.folder.rpartition("/")[0])
        return self

    def __exit__(self, *exc) -> None:
        if self.lease:
            self.lease.release()
        self.release()
