"""Results of a run that later steps read, written to the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import shared_folder

#: Spark's setting that removes the shuffle files of a query when it ends.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Spark's setting for the bytes of rows that go to a Python worker at once, and what it is set to. Spark
#: alone bounds the rows, 10,000, which for whole texts are tens of MB in the executor and again in each worker.
BATCH_BYTES, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20)

_LAST: dict[tuple[str, str], str] = {}


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python workers a few MB at a time, in all that the session runs from now on."""
    spark.conf.set(BATCH_BYTES, BATCH)


class Run:
    """A folder of one run of one operator.

    A result may be read from it long after the operator returned, so it is deleted only when the
    same operator is run again in this application: use or write a result before that.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        bounded_batches(spark)
        self.folder = f"{shared_folder(spark)}/tidemark/llm/{name}-{uuid.uuid4().hex}"
        key = (spark.sparkContext.applicationId, name)
        if key in _LAST:
            delete(spark, _LAST[key])
        _LAST[key] = self.folder

    def written(self, df: DataFrame, name: str, free: bool = False) -> DataFrame:
        """``df`` written and read again: computed once, and not lost with an executor.

        With ``free`` the shuffle files of the job go as soon as it is done, not when the driver happens
        to collect garbage.
        """
        path = f"{self.folder}/{name}"
        before = self.spark.conf.get(FREES_SHUFFLES, None)
        if free:
            self.spark.conf.set(FREES_SHUFFLES, "true")
        try:
            df.write.parquet(path)
        finally:
            if free and before is None:
                self.spark.conf.unset(FREES_SHUFFLES)
            elif free:
                self.spark.conf.set(FREES_SHUFFLES, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        delete(self.spark, f"{self.folder}/{name}")


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
