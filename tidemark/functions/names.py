"""Names of tables and columns."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

# What header cleaning and table naming replace.
HEADER_TO_UNDERSCORE = " -/."
HEADER_DROPPED = "()"
TABLE_TO_UNDERSCORE = " -"

_HEADER_RULE = str.maketrans(
    HEADER_TO_UNDERSCORE, "_" * len(HEADER_TO_UNDERSCORE), HEADER_DROPPED
)
_TABLE_RULE = str.maketrans(TABLE_TO_UNDERSCORE, "_" * len(TABLE_TO_UNDERSCORE))


def clean_header(header: str) -> str:
    return str(header).translate(_HEADER_RULE)


def table_name(sheet: str, prefix: str = "") -> str:
    return prefix + sheet.translate(_TABLE_RULE)


def table_name_column(sheet: Column) -> Column:
    """``table_name`` for sheet names held as rows, e.g. in an ingestion manifest."""
    return F.translate(sheet, TABLE_TO_UNDERSCORE, "_" * len(TABLE_TO_UNDERSCORE))


def clean_headers(headers: list[str]) -> list[str]:
    """Cleaned headers; raises where two of them become one name."""
    cleaned = [clean_header(h) for h in headers]
    # Spark resolves names without regard to case, so case alone does not separate them.
    counts = Counter(name.lower() for name in cleaned)
    clashes = [h for h, name in zip(headers, cleaned) if counts[name.lower()] > 1]
    if clashes:
        raise ValueError(f"headers equal after cleaning: {clashes}")
    return cleaned


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_headers(df.columns))


def business_name(column: str, key: str | None = None) -> str:
    """Column name in the prod tier.

    A dimension's own key ``X_ID`` is shown as ``X Code``; keys in facts keep their
    name; everything else shows spaces for underscores.
    """
    if column == key:
        return column.removesuffix("_ID").replace("_", " ") + " Code"
    if column.endswith("_ID"):
        return column
    return column.replace("_", " ")
