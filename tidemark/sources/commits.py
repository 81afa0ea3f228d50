"""Changing several months of a fact so that a crash at any moment loses and doubles nothing.

The files of a load are written aside, under ``_loads`` in the table's folder. Then an intent lists
all that is to be done: months that point to a new folder from now on, files that join a month, months
that go. Only then are the months changed one by one, the newest, which holds the watermark, last.
Every step can be taken twice. The next load first settles what it finds: an intent is carried out to
its end, files without one are thrown away. Folders that a load replaced stay for readers that still
use them, until the load after it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.conform import quoted
from tidemark.operators.upsert import MONTH
from tidemark.sources import tables

# A load leaves <id>.writing while its files are written, then <id>.intent, then <id>.done. Its increment
# lies in <id>.aside until then.
WRITING, INTENT, DONE = ".writing", ".intent", ".done"
ASIDE = ".aside"


def _loads(spark: SparkSession, spec) -> str:
    return f"{tables.location(spark, spec)}/_loads"


def _put(spark: SparkSession, path: str, text: str = "") -> None:
    """A whole file or none: written under another name first."""
    files, target = tables.file_system(spark, path)
    part = tables.file_system(spark, f"{path}.part")[1]
    stream = files.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    _rename(files, part, target)


def _read(spark: SparkSession, path: str) -> dict:
    files, target = tables.file_system(spark, path)
    stream = files.open(target)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _rename(files, old, new) -> None:
    if not files.rename(old, new):
        raise OSError(f"{old} could not be renamed to {new}")


def _delete(spark: SparkSession, folder: str) -> None:
    files, path = tables.file_system(spark, folder)
    files.delete(path, True)


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, path = tables.file_system(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []


def _partition(month: str) -> str:
    return f"PARTITION ({MONTH} = DATE'{month}')"


def month_folder(spark: SparkSession, spec, month: str) -> str:
    """Where a month's files are."""
    described = spark.sql(f"DESCRIBE FORMATTED {tables.ident(spec.full_name)} {_partition(month)}").collect()
    return next(r.data_type for r in described if r.col_name == "Location")


def apply(spark: SparkSession, spec, step: dict) -> None:
    """One step of an intent; a second time changes nothing."""
    table, part = tables.ident(spec.full_name), _partition(step["month"])
    if "folder" in step:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {part} LOCATION '{step['folder']}'")
        spark.sql(f"ALTER TABLE {table} {part} SET LOCATION '{step['folder']}'")
    elif "files" in step:
        for old, new in step["files"]:
            files, source = tables.file_system(spark, old)
            target = tables.file_system(spark, new)[1]
            if files.exists(source):
                _rename(files, source, target)
            elif not files.exists(target):
                raise OSError(f"neither {old} nor {new} is there")
    else:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {part}")


def _finish(spark: SparkSession, spec, loads: str, load: str) -> None:
    for step in _read(spark, f"{loads}/{load}{INTENT}")["steps"]:
        apply(spark, spec, step)
    files, intent = tables.file_system(spark, f"{loads}/{load}{INTENT}")
    _rename(files, intent, tables.file_system(spark, f"{loads}/{load}{DONE}")[1])
    spark.catalog.refreshTable(spec.full_name)


def settle(spark: SparkSession, spec) -> None:
    """Carry out what an earlier load meant to do, and remove what it left behind."""
    loads = _loads(spark, spec)
    names = _names(spark, loads)
    for name in names:
        load = name.rsplit(".", 1)[0]
        if name.endswith(INTENT):
            _finish(spark, spec, loads, load)
        elif name.endswith(WRITING):
            tables.drop_helper(spark, spec, load)
            if f"{load}{INTENT}" not in names:
                _delete(spark, f"{loads}/{load}")
            _delete(spark, f"{loads}/{load}{ASIDE}")
            _delete(spark, f"{loads}/{name}")
        elif name.endswith(DONE):
            for folder in _read(spark, f"{loads}/{name}")["replaced"]:
                _delete(spark, folder)
            _delete(spark, f"{loads}/{name}")


class Begun:
    """A load of a table that has been settled, and a folder for its increment on the table's file system.

    What is left there when the load ends goes; if the driver dies, the next load removes it.
    """

    def __init__(self, spark: SparkSession, spec):
        self.spark = spark
        self.loads, self.load = _loads(spark, spec), uuid.uuid4().hex
        self.folder = f"{self.loads}/{self.load}"
        self.marked = self.changing = False

    def __enter__(self) -> Begun:
        return self

    def __exit__(self, kind, *_) -> None:
        if self.marked:
            _delete(self.spark, f"{self.folder}{ASIDE}")
            if kind is None or not self.changing:  # else there may be other files that the next load is to remove
                _delete(self.spark, f"{self.folder}{WRITING}")

    def mark(self) -> None:
        if not self.marked:
            _put(self.spark, f"{self.folder}{WRITING}")
        self.marked = True

    def aside(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows (with their month) written as files of a fact that is not stored in buckets, and read back."""
        self.mark()
        rows.write.partitionBy(MONTH).parquet(f"{self.folder}{ASIDE}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.folder}{ASIDE}").select(*map(quoted, rows.columns))

    def take(self, months: Iterable[date]) -> None:
        """Files of whole months of the increment put to those that the load has written."""
        for month in months:
            files, source = tables.file_system(self.spark, f"{self.folder}{ASIDE}/{MONTH}={month}")
            target = tables.file_system(self.spark, f"{self.folder}/{MONTH}={month}")[1]
            if not files.exists(target):
                _rename(files, source, target)
                continue
            for name in _names(self.spark, source.toString()):
                _rename(files, *(tables.file_system(self.spark, f"{p.toString()}/{name}")[1] for p in (source, target)))


def change_months(
    rows: DataFrame, spec, replaced: Iterable[date] = (), begun: Begun | None = None, ready: Iterable[date] = ()
) -> None:
    """Make ``rows`` (with their month) the content of the ``replaced`` months, and add the others.

    A replaced month without rows goes. Months that only gain rows keep their files. Months of ``ready``
    are taken from the increment that ``begun`` has put aside. The table has been settled before.
    """
    spark = rows.sparkSession
    begun = begun or Begun(spark, spec)
    loads, load, folder = begun.loads, begun.load, begun.folder
    begun.mark()
    begun.changing = True
    tables.write_months(rows, spec, folder, load)
    begun.take(ready)
    held = {str(m) for m in tables.partition_values(spark, spec.full_name)}
    replaced = {str(m) for m in replaced}
    written = {n.split("=", 1)[1] for n in _names(spark, folder) if n.startswith(f"{MONTH}=")}
    steps, old = [], []
    for month in sorted(written | replaced):
        mine = f"{folder}/{MONTH}={month}"
        if month in replaced & held:
            old.append(month_folder(spark, spec, month))
        if month not in written:
            steps.append({"month": month})
        elif month in replaced or month not in held:
            steps.append({"month": month, "folder": mine})
        else:
            there = month_folder(spark, spec, month)
            steps.append({"month": month, "files": [[f"{mine}/{n}", f"{there}/{n}"] for n in _names(spark, mine)]})
    _put(spark, f"{folder}{INTENT}", json.dumps({"steps": steps, "replaced": old}))
    _delete(spark, f"{folder}{WRITING}")
    _finish(spark, spec, loads, load)
