"""Session settings the library counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Joins and writes are re-planned with the sizes met at run time; over-full partitions
    # of a hot key are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows are dealt into so many partitions and joined up to the size met at run time, so that what a
    # task holds does not grow with the tables where a session asks for few partitions.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # Facts have forty columns, mostly of few values: files are many times larger in memory, and slow to write.
    "spark.sql.files.maxPartitionBytes": "16m",
    # A task that writes a few months writes them side by side; only the rows of more are sorted first.
    "spark.sql.maxConcurrentOutputFileWriters": "12",
    # A projection of forty checked columns generates a method too long for the JIT, which
    # then runs interpreted. Above this limit Spark splits it into methods that compile.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tuned(spark: SparkSession) -> SparkSession:
    """The session with the library's settings; all can be set on a running one."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
