"""The run log: appending outcomes, retention, error digests."""

from __future__ import annotations

from threading import Lock
from zlib import crc32

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.dates import minus_hours, minute_text, second_text

# Columns of the log, the days it keeps, the hours a digest looks back, the
# longest error text, the tiers of the combined report and its line break.
LOG_DDL = (
    "LogID BIGINT, SchemaName STRING, ProcedureName STRING, StartTime TIMESTAMP_NTZ, "
    "EndTime TIMESTAMP_NTZ, RowsInserted BIGINT, RowsUpdated BIGINT, Status STRING, "
    "ErrorMessage STRING"
)
KEEP_DAYS = 40
LOOKBACK_HOURS = 3
ERROR_LENGTH = 4000
REPORT_TIERS = (("dev_data", "DEV"), ("test_data", "TEST"), ("prod_data", "PROD"))
LINE_BREAK = "\r"

LINES_PER_BLOCK = 10_000

LOG_COLUMNS = [column.split()[0] for column in LOG_DDL.split(", ")]


def to_second(value: Column) -> Column:
    """Rounded to the whole second, half up."""
    return second_text(value + F.expr("INTERVAL 500 MILLISECONDS")).cast("timestamp_ntz")


# A log id is put together from the second of the start, counted from ID_EPOCH, a number of the
# application and a counter, in so many bits.
ID_EPOCH = "2020-01-01"
APPLICATION_BITS, COUNTER_BITS = 16, 16

_LOCK = Lock()
_NEXT = 0


def application_number(application_id: str) -> int:
    return crc32(application_id.encode()) % (1 << APPLICATION_BITS)


def reserved(n: int) -> int:
    """The first of ``n`` counter values that no other append of this application gets."""
    global _NEXT
    with _LOCK:
        first, _NEXT = _NEXT, _NEXT + n
    return first


def log_ids(start: Column, nth: Column, application: int, first: int = 0) -> Column:
    """Ids that grow with the start and need no look at the log.

    Appends of one application differ in the counter, those of two at the same second in the
    application's number.
    """
    day = F.date_diff(start.cast("date"), F.lit(ID_EPOCH).cast("date")).cast("bigint")
    second = day * 86_400 + F.hour(start) * 3600 + F.minute(start) * 60 + F.second(start)
    most = 1 << COUNTER_BITS
    counter = F.when(nth <= most, F.pmod(nth - 1 + first, F.lit(most))).otherwise(
        F.raise_error(F.lit(f"more than {most} outcomes of one second"))
    )
    shifted = F.shiftleft(F.coalesce(second, F.lit(0).cast("bigint")), APPLICATION_BITS + COUNTER_BITS)
    return (shifted + F.lit(application << COUNTER_BITS) + counter).cast("bigint")


def outcome_rows(outcomes: DataFrame, application: int = 0, first: int = 0) -> DataFrame:
    """Outcomes as log rows. They are numbered within the second they start in, so no task sees all."""
    rows = outcomes.select(
        "SchemaName",
        "ProcedureName",
        to_second(F.col("StartTime")).alias("StartTime"),
        to_second(F.col("EndTime")).alias("EndTime"),
        F.col("RowsInserted").cast("bigint").alias("RowsInserted"),
        F.col("RowsUpdated").cast("bigint").alias("RowsUpdated"),
        "Status",
        F.left(F.col("ErrorMessage"), F.lit(ERROR_LENGTH)).alias("ErrorMessage"),
    )
    nth = F.row_number().over(Window.partitionBy("StartTime").orderBy("SchemaName", "ProcedureName"))
    numbered = rows.withColumn("nth", nth)
    return numbered.select(
        log_ids(F.col("StartTime"), F.col("nth"), application, first).alias("LogID"), *LOG_COLUMNS[1:]
    )


def appended(log: DataFrame, outcomes: DataFrame, application: int = 0, first: int = 0) -> DataFrame:
    return log.select(*LOG_COLUMNS).unionByName(outcome_rows(outcomes, application, first))


def expiry(as_of: Column, days: int = KEEP_DAYS) -> Column:
    return as_of - F.expr(f"INTERVAL {int(days)} DAYS")


def retained(log: DataFrame, as_of: Column, days: int = KEEP_DAYS) -> DataFrame:
    """The log without rows that started before the limit; a row without a start stays."""
    expired = F.col("StartTime") < expiry(as_of, days)
    return log.where(~F.coalesce(expired, F.lit(False)))


def error_digest(
    log: DataFrame, as_of: Column, hours: int = LOOKBACK_HOURS, show_unknown: bool = False
) -> DataFrame:
    """One row per tier: ``procedure: message`` of its recent errors, oldest first.

    An error without a message drops out, as text joined with NULL is NULL;
    ``show_unknown`` keeps it.

    The text of a tier is one value in the end, but it is put together in steps: lines of a
    second and a block of log ids, which as ids are unique are at most ``LINES_PER_BLOCK``,
    then minutes, then the tier. No task sorts all lines of a tier, or of a busy minute.
    """
    message = F.col("ErrorMessage")
    if show_unknown:
        message = F.coalesce(message, F.lit("unknown error"))
    lines = log.where(
        (F.col("Status") == "Error") & (F.col("StartTime") >= minus_hours(as_of, hours))
    ).select(
        "SchemaName",
        "StartTime",
        "LogID",
        F.concat("ProcedureName", F.lit(": "), message).alias("line"),
    )
    block = F.floor(F.col("LogID") / LINES_PER_BLOCK)
    blocks = lines.groupBy("SchemaName", "StartTime", block.alias("block")).agg(
        F.expr(_listagg("line", "LogID")).alias("lines")
    )
    minutes = blocks.groupBy("SchemaName", minute_text(F.col("StartTime")).alias("minute")).agg(
        F.expr(_listagg("lines", "StartTime, block")).alias("lines")
    )
    return minutes.groupBy("SchemaName").agg(F.expr(_listagg("lines", "minute")).alias("errors"))


def _listagg(text: str, order: str) -> str:
    """Texts joined with line breaks in the given order; NULL where there is none."""
    return f"listagg({text}, '{LINE_BREAK}') WITHIN GROUP (ORDER BY {order})"


def error_report(log: DataFrame, as_of: Column, hours: int = LOOKBACK_HOURS) -> DataFrame:
    """One row: a block per tier that has errors, or an empty text."""
    digest = error_digest(log, as_of, hours)
    blocks = []
    for schema, title in REPORT_TIERS:
        errors = F.max(F.when(F.col("SchemaName") == schema, F.col("errors")))
        blocks.append(F.concat(F.lit(f"{title}:{LINE_BREAK}"), errors))
    return digest.agg(F.concat_ws(LINE_BREAK * 2, *blocks).alias("FormattedErrorList"))
