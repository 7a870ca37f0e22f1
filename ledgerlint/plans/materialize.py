"""Intermediate results written once to the shared folder, with an owner that deletes them.

Used where several actions read the same expensive result.  A parquet table
(rather than an RDD checkpoint) is written in a single job, lets each reader
prune to the columns it needs, and cuts the lineage.  It is not bucketed: the
readers' tasks then follow the size of the data, not a bucket count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_path


class Intermediates:
    """Folders written for one run; a context manager that deletes them at its end."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def write(self, df: DataFrame, stem: str) -> DataFrame:
        path = fresh_path(self.spark, stem)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Delete what was written, through the Hadoop FileSystem of each path, so on any shared store."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        while self.paths:
            p = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            p.getFileSystem(conf).delete(p, True)

    def __enter__(self) -> Intermediates:
        return self

    def __exit__(self, *_) -> None:
        self.close()
