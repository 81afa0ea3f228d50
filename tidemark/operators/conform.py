"""Bringing rows to a table's declared columns, and guessing types for raw ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column as SparkColumn, DataFrame, functions as F

from tidemark.plans.specs import Column

# Types a value can be read as, narrowest first. A value stands for the set of those that it fits,
# a bit each, and a column for the set that all its values fit: a lattice, whose meet is a bitwise
# and. Text fits everything.
TYPES = ("boolean", "bigint", "double", "timestamp_ntz", "string")
LOOKS_LIKE = {
    "bigint": r"^\s*[+-]?\d+\s*$",
    "double": r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$",
    "timestamp_ntz": r"^\s*\d{4}-",
}


def quoted(name: str, side: str | None = None) -> SparkColumn:
    """Column by exact name, also one with spaces in it."""
    return F.col(f"{side}.`{name}`" if side else f"`{name}`")


def conform_column(column: Column, value: SparkColumn) -> SparkColumn:
    """``value`` cast to the declared type; NULL keys and over-long text stop the job.

    The checks are part of the projection, so they cost no pass of their own. Whether
    text is too long is asked before the cast, as the warehouse does on insert.
    """
    if column.max_length is not None:
        value = value.cast("string")
        value = F.when(
            F.length(value) > column.max_length,
            F.raise_error(F.lit(f"{column.name}: text longer than {column.type}")),
        ).otherwise(value)
    else:
        value = value.cast(column.type)
    if column.required:
        value = F.when(
            value.isNull(), F.raise_error(F.lit(f"{column.name}: NULL in a NOT NULL column"))
        ).otherwise(value)
    return value.alias(column.name)


def conform(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """The declared columns of ``df``, in declared order and type, checked."""
    return df.select(*[conform_column(c, quoted(c.name)) for c in columns])


def fitting(*types: str) -> SparkColumn:
    """The set of the given types and text."""
    return F.lit(sum(1 << TYPES.index(t) for t in {*types, "string"}))


def text_types(text: SparkColumn) -> SparkColumn:
    """What a text can be read as; NULL for NULL.

    Casting is tried only on text of the right look: a failed cast to a number costs an
    exception each, and most text columns fail in every row.
    """

    def readable(kind: str) -> SparkColumn:
        return text.rlike(LOOKS_LIKE[kind]) & text.try_cast(kind).isNotNull()

    return (
        F.when(text.isNull(), F.lit(None))
        .when(readable("bigint"), fitting("bigint", "double"))
        .when(readable("double"), fitting("double"))
        .when(readable("timestamp_ntz"), fitting("timestamp_ntz"))
        .otherwise(fitting())
    )


def column_types(df: DataFrame, sets: Sequence[tuple[str, SparkColumn]]) -> DataFrame:
    """One row per column, given its name and what each value fits: how many values it has and the
    narrowest type that all of them fit; text where there is none.

    A single aggregation over the whole table; partial results are merged per task.
    """
    facts = []
    for i, (_, fits) in enumerate(sets):
        facts += [F.count(fits).alias(f"n{i}"), F.bit_and(fits).alias(f"fits{i}")]
    columns = []
    for i, (name, _) in enumerate(sets):
        kind = F.lit("string")
        for bit, candidate in reversed(list(enumerate(TYPES))):
            kind = F.when(F.col(f"fits{i}").bitwiseAND(F.lit(1 << bit)) != 0, candidate).otherwise(kind)
        columns.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"n{i}").alias("n_values"),
                kind.alias("inferred_type"),
            )
        )
    return df.agg(*facts).select(F.inline(F.array(*columns)))


def inferred_types(df: DataFrame) -> DataFrame:
    """One row per text column: how many values it has and the narrowest type they all fit."""
    return column_types(df, [(name, text_types(quoted(name).cast("string"))) for name in df.columns])


def with_inferred_types(df: DataFrame) -> DataFrame:
    """``df`` with each text column cast to its inferred type.

    Only the type names come to the driver, one per column.
    """
    types = {r.column_name: r.inferred_type for r in inferred_types(df).collect()}
    return df.select(*[quoted(c).cast(types[c]).alias(c) for c in df.columns])
