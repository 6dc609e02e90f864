"""Long work in steps, so that its shuffles are not all on disk at the same time.

Spark keeps the shuffle files of a plan until nobody holds the plan any more, so a plan of ten shuffles needs
disk for all ten.  A step ends with its rows in the shared folder, compressed by column; its shuffle files are
deleted at once, and what it was made from as soon as no later step reads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import ensure_checkpoint_dir

_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Steps:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/steps-{uuid.uuid4().hex}"

    def saved(self, name: str, rows: DataFrame) -> DataFrame:
        """The rows, read from where they have been written to."""
        conf, path = self.spark.conf, f"{self.root}/{name}"
        before = conf.get(_FREED)
        conf.set(_FREED, "true")
        try:
            rows.write.parquet(path, compression="zstd")
        finally:
            conf.set(_FREED, before)
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete what no later step reads; names that were never saved are left out."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
