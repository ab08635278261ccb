"""Intermediate tables in the shared folder of the session.

Long plans are cut by writing a Parquet table below ``spark.checkpoint.dir``
(see ``repotrend.session.work_dir``) and reading it back, so a lost executor
costs a re-read and not a recomputation of everything before.  With ``tidy``, the
shuffle files of such a write go when it ends, not when the driver happens to
collect its garbage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repotrend.session import work_dir


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Written tables of one operator call, in a folder of their own."""

    def __init__(self, spark: SparkSession, tidy: bool = False):
        self.spark = spark
        self.tidy = tidy
        self.root = work_dir(spark)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        before = self.spark.conf.get(CLEANUP, None)
        if self.tidy:
            self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(self.path(name))
        finally:
            if self.tidy:
                self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
