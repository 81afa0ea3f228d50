"""Warehouse tables: creating, replacing, adding to and looking at them."""

from __future__ import annotations

import json
import re
import tempfile
import time
import uuid
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidemark.functions.dates import month_start
from tidemark.operators.conform import quoted
from tidemark.operators.refresh import counted
from tidemark.operators.upsert import MONTH

# Months that a file of staged rows may hold on average to be written as it lies.
MONTHS_OF_A_FILE = 4

PREVIEW_ROWS = 3
PREVIEW_NAMES = 5
TEXT_TYPES = ("string", "varchar", "char")

# Folders of a dimension's refreshes, named in order of time, and how many of them stay.
VERSION = "version="
KEEP_VERSIONS = 2

_LOCAL_FOLDERS: dict[str, str] = {}

# A table option: an overwriting insert replaces only the partitions it has rows of, and may
# read the table it writes, since files are moved in place after the job is done.
REPLACE_BY_PARTITION = "OPTIONS (partitionOverwriteMode 'dynamic')"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: the one the cluster names for checkpoints.

    Only a local session may name none: a temporary folder then serves it, and the session's
    settings stay as they are. On a cluster a folder of one machine would lose rows, so that is an
    error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
        folder = _LOCAL_FOLDERS[context.applicationId]
    return folder.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, *partition_by: str, folder: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Lost executors then cost no recomputation, the rows stay what they were, and Spark
    plans with the real size.
    """
    spark = df.sparkSession
    path = f"{folder}/{name}" if folder else staging_path(spark, name)
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*map(quoted, df.columns))


class Staging:
    """Staged DataFrames of one job, deleted together when it ends."""

    def __init__(self, spark: SparkSession, job: str):
        self.spark = spark
        self.folder = staging_path(spark, job)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        files, path = file_system(self.spark, self.folder)
        files.delete(path, True)

    def write(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        return staged(df, name, *partition_by, folder=self.folder)


def total_size(df: DataFrame) -> Column:
    """Sum over the rows of the bytes they take in memory, about: texts at their length, 16 a value."""
    texts = [F.coalesce(F.octet_length(quoted(f.name)), F.lit(0)) for f in df.schema if f.dataType.typeName() in TEXT_TYPES]
    length = sum(texts, F.lit(16 * len(df.columns)))
    return F.coalesce(F.sum(length.cast("long")), F.lit(0))


def file_system(spark: SparkSession, folder: str):
    """The file system a folder is on, and the folder as its path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def ident(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_if_missing(spark: SparkSession, spec) -> None:
    """The declared table, empty. Facts are stored by month of their event.

    VARCHAR(n) is declared as such, so Spark refuses longer text on every write.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ident(spec.schema_name)}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ident(spec.full_name)} {_layout(spec)}")


def _layout(spec) -> str:
    columns = [f"`{c.name}` {c.type}" for c in spec.columns]
    stored_by = ""
    if spec.is_fact:
        columns.append(f"{MONTH} DATE")
        stored_by = f"{REPLACE_BY_PARTITION} PARTITIONED BY ({MONTH})"
        if spec.buckets:
            stored_by += f" CLUSTERED BY (`{spec.key}`) INTO {spec.buckets} BUCKETS"
    return f"({', '.join(columns)}) USING parquet {stored_by}"


def write_months(rows: DataFrame, spec, folder: str, name: str) -> None:
    """Rows (with their month) as files of a fact, in a folder of their own.

    Only a table can be written in buckets: one that points to the folder, and leaves its files there
    when it is dropped.
    """
    if not spec.buckets:
        rows.write.partitionBy(MONTH).parquet(folder)
        return
    spark = rows.sparkSession
    drop_helper(spark, spec, name)
    spark.sql(f"CREATE TABLE {_helper(spec, name)} {_layout(spec)} LOCATION '{folder}'")
    try:
        rows.select(*map(quoted, [*spec.names, MONTH])).write.insertInto(_helper(spec, name))
    finally:
        drop_helper(spark, spec, name)


def _helper(spec, name: str) -> str:
    return ident(f"{spec.schema_name}.load_{name}")


def drop_helper(spark: SparkSession, spec, name: str) -> None:
    if spec.buckets:
        spark.sql(f"DROP TABLE IF EXISTS {_helper(spec, name)}")


def spread(rows: DataFrame, spec) -> DataFrame:
    """Rows (with their month) dealt out to be written: by bucket, or by month with the sizes known at
    run time, so that a month holding most of the rows is written by many tasks and small ones share one."""
    if spec.buckets:
        return rows.repartition(spec.buckets, quoted(spec.key))
    return rows.hint("rebalance", MONTH)


def lies_by_month(rows: DataFrame, spec) -> bool:
    """Whether the files of staged rows hold few months each, so that rows can be written as they lie.

    Only the event column is read. Rows written as they lie make a file per task and month.
    """
    month = month_start(quoted(spec.event))
    files = rows.groupBy(F.input_file_name()).agg(F.size(F.collect_set(month)).alias("n_months"))
    average = files.agg(F.avg("n_months")).first()[0]
    return average is not None and average <= MONTHS_OF_A_FILE


def table_rows(spark: SparkSession, spec) -> DataFrame:
    """A table's declared columns."""
    return spark.table(ident(spec.full_name)).select(*map(quoted, spec.names))


def overwrite(df: DataFrame, name: str) -> None:
    """Replace a table, its schema included."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def create_only(df: DataFrame, name: str) -> None:
    """Create a table; an existing one is an error."""
    df.write.mode("errorifexists").format("parquet").saveAsTable(name)


def recreate(spark: SparkSession, name: str, columns: dict[str, str]) -> None:
    """Drop a table, if there is one, and create it empty with columns of the given types."""
    listed = ", ".join(f"`{column}` {kind}" for column, kind in columns.items())
    spark.sql(f"DROP TABLE IF EXISTS {ident(name)}")
    spark.sql(f"CREATE TABLE {ident(name)} ({listed}) USING parquet")


def append_by_position(df: DataFrame, name: str) -> None:
    """Insert into a typed table by position; values are cast to its types."""
    spark = df.sparkSession
    target = spark.table(name).schema
    if len(target) != len(df.columns):
        raise ValueError(f"{name} has {len(target)} columns, the rows have {len(df.columns)}")
    cast = [
        quoted(c).cast(field.dataType).alias(field.name)
        for c, field in zip(df.columns, target)
    ]
    df.select(*cast).write.insertInto(name)


def location(spark: SparkSession, spec) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {ident(spec.full_name)} AS JSON").first()[0]
    return json.loads(described)["location"]


def _base_folder(spark: SparkSession, spec) -> str:
    return location(spark, spec).split(f"/{VERSION}")[0]


def replace_rows(df: DataFrame, spec, keep: int = KEEP_VERSIONS) -> Observation:
    """Full refresh: new rows go to a folder of their own, then the table points there.

    The table keeps its old rows until all new ones are written, and for good if writing
    fails. The row count is taken on the way. After the switch the newest ``keep`` folders
    stay, the one just written among them, for readers that still use an older one.
    """
    spark = df.sparkSession
    create_if_missing(spark, spec)
    path = f"{_base_folder(spark, spec)}/{VERSION}{time.time_ns():020d}-{uuid.uuid4().hex}"
    rows, seen = counted(df)
    rows.write.parquet(path)
    spark.sql(f"ALTER TABLE {ident(spec.full_name)} SET LOCATION '{path}'")
    spark.catalog.refreshTable(spec.full_name)
    drop_old_versions(spark, spec, keep)
    return seen


def drop_old_versions(spark: SparkSession, spec, keep: int = 1) -> None:
    """Delete the folders of refreshes, but for the current one and ``keep`` - 1 before it.

    What a failed refresh left is older than the next one and goes with the others.
    """
    current = location(spark, spec).rsplit("/", 1)[-1]
    files, base = file_system(spark, _base_folder(spark, spec))
    found = {s.getPath().getName(): s.getPath() for s in files.listStatus(base)}
    older = sorted(n for n in found if n.startswith(VERSION) and n < current)
    for name in older[: max(0, len(older) - (keep - 1))]:
        files.delete(found[name], True)


def with_month(df: DataFrame, spec) -> DataFrame:
    return df.withColumn(MONTH, month_start(quoted(spec.event)))


def by_month(df: DataFrame, spec) -> DataFrame:
    return spread(with_month(df, spec), spec)


def append_months(rows: DataFrame, spec) -> None:
    """Add rows (with their month) to a fact; nothing is read or rewritten."""
    rows.write.insertInto(ident(spec.full_name))


def partition_values(spark: SparkSession, name: str) -> list[date]:
    """Values of a table's only partition column, a DATE; asks the catalog, reads no file."""
    listed = spark.sql(f"SHOW PARTITIONS {ident(name)}").collect()
    return sorted(date.fromisoformat(r[0].split("=")[1]) for r in listed)


def preview(df: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    return df.limit(rows)


def profile(df: DataFrame, name: str) -> DataFrame:
    """One row: rows, columns and the first column names of a table."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(", ".join(df.columns[:PREVIEW_NAMES])).alias("first_columns"),
    )


def profiles(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile(df, name) for name, df in tables.items()])
