"""Running the loads against catalog tables.

``load`` runs one of the 39 loads, ``run_tier`` all of a tier, and both leave one row per
load in the run log. Raw tables live in the database named by ``raw``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import astuple, dataclass, replace
from datetime import datetime, timedelta, timezone
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.functions.dates import moment
from tidemark.functions.names import table_name
from tidemark.operators import runlog, upsert
from tidemark.operators.conform import quoted
from tidemark.operators.refresh import counted, refreshed, with_first_event
from tidemark.operators.upsert import MONTH
from tidemark.plans.specs import DEV, SPECS, TableSpec
from tidemark.sources import commits, tables, workbook

RAW = "raw_data"
LOG = "admin_logging.ExecutionLogs"
LOG_DAY = "log_day"

# Bounds for a broadcast: keys of an increment (a BIGINT each), and bytes in memory of the
# increment that updates a fact. Beyond them the join is a shuffled one.
BROADCAST_KEYS = 5_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Of what a row of an increment does: whether it is new.
ADDS = "adds"


class AmbiguousUpsert(ValueError):
    """More than one increment row would change one target row."""


@dataclass(frozen=True)
class Outcome:
    SchemaName: str
    ProcedureName: str
    StartTime: datetime
    EndTime: datetime
    RowsInserted: int
    RowsUpdated: int
    Status: str
    ErrorMessage: str | None
    # Why the outcome is not in the run log; no column of the log.
    LogError: str | None = None


# Columns of the log that an outcome fills, in their order there.
OUTCOME_DDL = (
    "SchemaName string, ProcedureName string, StartTime timestamp_ntz, EndTime timestamp_ntz, "
    "RowsInserted bigint, RowsUpdated bigint, Status string, ErrorMessage string"
)


def procedure_name(spec: TableSpec) -> str:
    """Name of a load in the run log."""
    raw = DEV[spec.table].source
    # Fixed value: the one load whose name is not that of its raw table.
    raw = {"fact_purchases": "fact_purchase"}.get(raw, raw)
    return f"pr_{spec.tier}_{raw}"


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


# ---- raw tier ---------------------------------------------------------------------------


def ingest_workbooks(
    spark: SparkSession,
    folder: str | None = None,
    raw: str = RAW,
    prefix: str = "",
    overwrite: bool = True,
    files: DataFrame | None = None,
) -> list[Outcome]:
    """Every sheet of the workbooks under ``folder`` as a raw table.

    The workbooks are decoded once. A sheet that cannot be read or loaded is reported and
    the others go on. ``files`` (path, content) stands in for a folder.
    """
    with tables.Staging(spark, "workbooks") as staging:
        files = workbook.workbook_files(spark, folder) if files is None else files
        rows = staging.write(workbook.sheet_rows(files), "sheets", "sheet")
        failed = rows.where(F.col("error").isNotNull()).select("workbook", "sheet", "error")
        outcomes = [
            Outcome(raw, f"{r.workbook} {r.sheet or ''}".strip(), _now(), _now(), 0, 0, "Error", r.error)
            for r in failed.toLocalIterator()
        ]
        good = workbook.good_rows(rows)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {raw}")
        sheets = sorted(r.sheet for r in good.select("sheet").distinct().toLocalIterator())
        names = {sheet: f"{raw}.{table_name(sheet, prefix).lower()}" for sheet in sheets}
        taken = Counter(names.values())
        for sheet, name in names.items():
            job = partial(_write_sheet, good, sheet, name, overwrite, taken[name])
            outcomes.append(_captured(raw, name, job)[0])
    return outcomes


def _write_sheet(
    rows: DataFrame, sheet: str, name: str, overwrite: bool, claims: int
) -> tuple[int, int]:
    if claims > 1:
        raise ValueError(f"{claims} sheets, {sheet} among them, would become {name}")
    df, seen = counted(workbook.sheet_table(rows, sheet))
    (tables.overwrite if overwrite else tables.create_only)(df, name)
    return seen.get["n"], 0


# ---- one load ---------------------------------------------------------------------------


def _source(spark: SparkSession, spec: TableSpec, raw: str) -> DataFrame:
    name = spec.source if "." in spec.source else f"{raw}.{spec.source}"
    return spark.table(name)


def load_dimension(
    spark: SparkSession,
    spec: TableSpec,
    raw: str = RAW,
    source: DataFrame | None = None,
    sales: DataFrame | None = None,
) -> tuple[int, int]:
    """Full refresh of one dimension; rows inserted, and none updated.

    ``source`` and ``sales`` stand in for the tables that the spec, or the launch dates of the test
    products, are read from.
    """
    rows = _source(spark, spec, raw) if source is None else source
    if "Launch_Date" in spec.names:
        sales = spark.table("dev_data.Sales") if sales is None else sales
        rows = with_first_event(rows, sales, "Product_ID", "Transaction_DateTime", "Launch_Date")
    seen = tables.replace_rows(refreshed(rows, spec), spec)
    return seen.get["n"], 0


def load_fact(
    spark: SparkSession,
    spec: TableSpec,
    raw: str = RAW,
    as_of: datetime | None = None,
    lookback_days: int = 0,
    broadcast_keys: int = BROADCAST_KEYS,
    broadcast_bytes: int = BROADCAST_BYTES,
    source: DataFrame | None = None,
    corrections: bool = False,
) -> tuple[int, int]:
    """Incremental upsert of one fact; rows inserted and updated.

    ``source`` stands in for the table the spec names as its source. With ``corrections`` rows older
    than the watermark are taken too where they change a row of the table, however old they are.

    The whole rows of the source are read once: the increment is written to the shared folder, and all
    that follows reads it from there with its size known. Where it lies by month it is written beside the
    table as files of its months, and months that only bring new rows join the table as they are. The
    target is scanned once for key and compared columns. Without updates new rows are appended and nothing is rewritten; else
    the months with a change are read in full and replaced in one write.
    """
    tables.create_if_missing(spark, spec)
    commits.settle(spark, spec)
    with tables.Staging(spark, spec.table) as staging, commits.Begun(spark, spec) as begun:
        source = _source(spark, spec, raw) if source is None else source
        return _upsert(source, spec, as_of, lookback_days, staging, begun, broadcast_keys, broadcast_bytes, corrections)


def _upsert(
    source: DataFrame,
    spec: TableSpec,
    as_of: datetime | None,
    lookback_days: int,
    staging: tables.Staging,
    begun: commits.Begun,
    broadcast_keys: int,
    broadcast_bytes: int,
    corrections: bool,
) -> tuple[int, int]:
    """Six passes, and one more where keys repeat: the watermark, the increment with its size, repeated
    keys, what the target holds of the increment's keys, what changes of it, the new files. Spark runs each
    as a few jobs. Between the increment and the files only keys and compared columns are moved."""
    spark = source.sparkSession
    table = spark.table(spec.full_name)
    months = tables.partition_values(spark, spec.full_name)
    newest = table.where(F.col(MONTH) == F.lit(months[-1])) if months else table
    since = upsert.watermark_literal(newest, spec.event)
    found = upsert.increment(source, spec.source_event, since, lookback_days)
    shaped = upsert.shaped_for(spec, found, moment(as_of))
    if corrections:
        limit = since - F.expr(f"INTERVAL {int(lookback_days)} DAYS")
        older = upsert.shaped_for(spec, source, moment(as_of))
        ranges = partial(staging.write, name="ranges")
        shaped = shaped.union(upsert.late_corrections(older, table, spec, limit, ranges).select(*map(quoted, spec.names)))
    shaped = tables.with_month(shaped, spec)
    by_month = not (corrections or spec.buckets) and tables.lies_by_month(shaped, spec)
    written, n_rows, size = _sized(shaped, begun.aside if by_month else staging.write, "increment")
    rows = _unambiguous(table, written, spec, staging)

    held, n_held, held_size = _sized(_held(table, rows, spec, n_rows <= broadcast_keys), staging.write, "held")
    seen = Observation("known months")
    effects = staging.write(_effects(rows, held, spec, held_size <= broadcast_bytes, seen), "effects", ADDS)
    counts = effects.groupBy(ADDS, MONTH).count().collect()
    n_inserted = sum(r["count"] for r in counts if r[ADDS])
    n_updated = sum(r["count"] for r in counts if not r[ADDS])
    if not counts:
        return 0, 0
    ready = []
    if by_month and rows is written:
        ready = [r[MONTH] for r in counts if r[ADDS] and str(r[MONTH]) not in seen.get["months"].split()]
    known = held.select(quoted(spec.key))
    adds = rows.where(~F.col(MONTH).isin(ready)).join(F.broadcast(known) if n_held <= broadcast_keys else known, spec.key, "left_anti")
    new = adds.select(*map(quoted, [*spec.names, MONTH]))
    if spec.buckets or n_held > broadcast_keys or not (by_month or tables.lies_by_month(rows, spec)):
        new = tables.spread(new, spec)
    rewritten = sorted({r[MONTH] for r in counts if not r[ADDS]})
    if rewritten:
        part = table.where(F.col(MONTH).isin(rewritten))
        changed = effects.where(~F.col(ADDS)).select(quoted(spec.key)).distinct()
        changed = F.broadcast(changed) if n_updated <= broadcast_keys else changed
        updates = rows.join(changed, spec.key, "left_semi")
        small = size <= broadcast_bytes
        kept = tables.with_month(upsert.updated(part, F.broadcast(updates) if small else updates, spec), spec)
        if spec.buckets:
            files = tables.spread(kept.unionByName(new), spec)
        else:
            # With a broadcast the rewritten rows stay in the tasks that read them, month by month.
            files = (kept if small else tables.spread(kept, spec)).unionByName(new)
        commits.change_months(files, spec, rewritten, begun, ready)
    else:
        commits.change_months(new, spec, (), begun, ready)
    return n_inserted, n_updated


def _sized(df: DataFrame, write: Callable[[DataFrame, str], DataFrame], name: str) -> tuple[DataFrame, int, int]:
    """``df`` written and read back, its number of rows and bytes in memory; both are taken on the way."""
    seen = Observation(name)
    observed = df.observe(seen, F.count(F.lit(1)).alias("n"), tables.total_size(df).alias("size"))
    return write(observed, name), seen.get["n"], seen.get["size"]


def _compared(spec: TableSpec) -> list[str]:
    return [spec.key, *spec.compare, *spec.compare_null_safe]


def _held(table: DataFrame, rows: DataFrame, spec: TableSpec, broadcast: bool) -> DataFrame:
    """What the target holds of the increment's keys: key, compared columns and month.

    Up to a checked number of keys that takes a broadcast, and the target's rows are not shuffled.
    Beyond it they are not either where the table is stored in buckets.
    """
    keys = rows.select(quoted(spec.key))
    keys = F.broadcast(keys) if broadcast else keys.hint("merge")
    return table.select(*map(quoted, _compared(spec)), MONTH).join(keys, spec.key, "left_semi")


def _effects(rows: DataFrame, held: DataFrame, spec: TableSpec, broadcast: bool, seen: Observation | None = None) -> DataFrame:
    """What the increment does: key and month of its rows that are new, and for each target row that changes
    its key and month, once for each increment row that changes it.

    ``seen`` gets the ``months`` in which the increment has rows that are not new.
    """
    adds = quoted(spec.key, "t").isNull()
    rows, held = (df if MONTH in df.columns else tables.with_month(df, spec) for df in (rows, held))
    pairs = (
        rows.select(*map(quoted, _compared(spec)), MONTH)
        .alias("s")
        .join((F.broadcast(held) if broadcast else held).alias("t"), upsert.same_key(spec), "left")
    )
    if seen is not None:
        known = F.collect_set(F.when(~adds, quoted(MONTH, "s").cast("string")))
        pairs = pairs.observe(seen, F.array_join(known, " ").alias("months"))
    return (
        pairs.where(adds | F.coalesce(upsert.is_changed(spec), F.lit(False)))
        .select(
            quoted(spec.key, "s").alias(spec.key),
            F.when(adds, quoted(MONTH, "s")).otherwise(quoted(MONTH, "t")).alias(MONTH),
            adds.alias(ADDS),
        )
    )


def _unambiguous(
    table: DataFrame, rows: DataFrame, spec: TableSpec, staging: tables.Staging
) -> DataFrame:
    """The increment, once it is sure that no target row is changed twice."""
    repeated, n_repeated, _ = _sized(upsert.repeated_keys(rows, spec.key), staging.write, "repeated")
    if not n_repeated:
        return rows
    changes = staging.write(upsert.changes_per_key(table, rows, spec, repeated), "repeats")
    twice = changes.where(F.col("n_changes") > 1)
    first = twice.orderBy(quoted(spec.key)).take(5)
    if first:
        keys = ", ".join(str(r[0]) for r in first)
        raise AmbiguousUpsert(
            f"{spec.full_name}: several rows would change one row, {twice.count()} keys, the first {keys}"
        )
    return staging.write(upsert.without_copies(rows, changes, spec), "single")


# ---- run log ----------------------------------------------------------------------------


def _captured(
    schema: str, name: str, job: Callable[[], tuple[int, int]]
) -> tuple[Outcome, Exception | None]:
    """Run a job; a failure becomes part of its outcome, with no rows counted."""
    start = _now()
    try:
        inserted, updated = job()
    except Exception as error:
        text = str(error) or type(error).__name__
        failed = Outcome(schema, name, start, _now(), 0, 0, "Error", text[: runlog.ERROR_LENGTH])
        return failed, error
    return Outcome(schema, name, start, _now(), inserted, updated, "Success", None), None


def create_log(spark: SparkSession, log: str = LOG) -> None:
    """The run log, stored by day so that retention drops whole days."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {log.split('.')[0]}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {log} ({runlog.LOG_DDL}, {LOG_DAY} DATE) "
        f"USING parquet {tables.REPLACE_BY_PARTITION} PARTITIONED BY ({LOG_DAY})"
    )


def log_rows(spark: SparkSession, log: str = LOG) -> DataFrame:
    return spark.table(log).select(*runlog.LOG_COLUMNS)


def append_log(spark: SparkSession, outcomes: list[Outcome], log: str = LOG) -> None:
    """Add outcomes to the log, which is not read for it; several applications may do so at once."""
    create_log(spark, log)
    rows = [astuple(replace(o, LogError=None))[:-1] for o in outcomes]
    batch = spark.createDataFrame(rows, OUTCOME_DDL)
    application = runlog.application_number(spark.sparkContext.applicationId)
    rows = runlog.outcome_rows(batch, application, runlog.reserved(len(outcomes)))
    _with_day(rows).coalesce(1).write.insertInto(log)


def _with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn(LOG_DAY, F.col("StartTime").cast("date"))


def retain_log(spark: SparkSession, as_of: datetime | None = None, log: str = LOG) -> None:
    """Drop expired days and rewrite the one the limit falls in."""
    as_of = as_of or _now()
    limit = as_of - timedelta(days=runlog.KEEP_DAYS)
    days = tables.partition_values(spark, log)
    expired = [d for d in days if d < limit.date()]
    if limit.date() in days:
        boundary = spark.table(log).where(F.col(LOG_DAY) == F.lit(limit.date()))
        kept = runlog.retained(boundary, moment(as_of))
        if kept.isEmpty():
            expired.append(limit.date())
        else:
            kept.write.mode("overwrite").insertInto(log)
    for day in expired:
        spark.sql(f"ALTER TABLE {log} DROP IF EXISTS PARTITION ({LOG_DAY} = DATE'{day}')")
    spark.catalog.refreshTable(log)


# ---- loads and tiers --------------------------------------------------------------------


def _logged(
    spark: SparkSession, spec: TableSpec, raw: str, as_of: datetime | None, lookback_days: int, log: str
) -> tuple[Outcome, Exception | None]:
    """Run one load and log it. What keeps the log from being written stands in the outcome.

    ``as_of`` is the date the loads count from; the log is kept by the clock.
    """

    def job() -> tuple[int, int]:
        if spec.is_fact:
            return load_fact(spark, spec, raw, as_of, lookback_days)
        return load_dimension(spark, spec, raw)

    outcome, cause = _captured(spec.schema_name, procedure_name(spec), job)
    try:
        append_log(spark, [outcome], log)
        retain_log(spark, log=log)
    except Exception as error:
        outcome = replace(outcome, LogError=f"{type(error).__name__}: {error}")
    return outcome, cause


def load(
    spark: SparkSession,
    tier: str,
    table: str,
    raw: str = RAW,
    as_of: datetime | None = None,
    lookback_days: int = 0,
) -> Outcome:
    """Run one load and log it; a failure is logged and then raised."""
    outcome, cause = _logged(spark, SPECS[tier][table], raw, as_of, lookback_days, LOG)
    if cause is not None:
        raise RuntimeError(outcome.ErrorMessage) from cause
    return outcome


def run_loads(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    raw: str = RAW,
    as_of: datetime | None = None,
    lookback_days: int = 0,
    log: str = LOG,
) -> list[Outcome]:
    """Run loads one after the other and log each.

    Neither a failing load nor a log that cannot be written stops the others.
    """
    return [_logged(spark, spec, raw, as_of, lookback_days, log)[0] for spec in specs]


def run_tier(
    spark: SparkSession,
    tier: str,
    raw: str = RAW,
    as_of: datetime | None = None,
    lookback_days: int = 0,
) -> list[Outcome]:
    """Run all loads of a tier, facts first."""
    return run_loads(spark, SPECS[tier].values(), raw, as_of, lookback_days)
