"""Full refresh of dimensions and promotion between tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tidemark.functions.dates import moment
from tidemark.operators.conform import quoted
from tidemark.operators.upsert import shaped_for


def refreshed(source: DataFrame, spec) -> DataFrame:
    """All rows of a dimension's source as rows of its table."""
    return shaped_for(spec, source, moment())


def with_first_event(
    rows: DataFrame, events: DataFrame, key: str, event: str, name: str
) -> DataFrame:
    """``rows`` with the earliest ``event`` of their key, NULL where there is none.

    The events are reduced to one row per key before the join, partly before the shuffle,
    so a key with very many events costs no more than another.
    """
    first = events.groupBy(quoted(key)).agg(F.min(quoted(event)).alias(name))
    return rows.join(first, key, "left")


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` and a counter that holds its number of rows once it has been written."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen
