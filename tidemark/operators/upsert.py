"""Incremental upsert: high watermark, increment, change detection, updated and new rows.

Every function takes and returns DataFrames and works for any table with a key, an event
column and a list of compared columns. ``rule`` is a ``TableSpec`` or anything with its
``key``, ``names``, ``compare``, ``compare_null_safe`` and ``never_updated``.

Keys are joined with plain equi-joins. Which side is broadcast, and how an over-full
partition is split, is left to Spark, which knows the sizes at run time.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import month_start
from tidemark.operators.conform import conform_column, quoted

# The watermark of an empty table.
FLOOR = "1900-01-01"

# Facts are stored by month of their event column.
MONTH = "event_month"


def watermark(target: DataFrame, event: str) -> DataFrame:
    """One row: the newest event in ``target``, or the floor where it has none."""
    kind = target.schema[event].dataType
    newest = F.max(quoted(event))
    return target.agg(F.coalesce(newest, F.lit(FLOOR).cast(kind)).alias("watermark"))


def watermark_literal(target: DataFrame, event: str) -> Column:
    """The watermark as a literal, which scans can use to skip data; one value is collected.

    For a target stored by month its newest month is enough.
    """
    return F.lit(str(watermark(target, event).first()[0])).cast(target.schema[event].dataType)


def increment(
    source: DataFrame, event: str, since: Column, lookback_days: int = 0
) -> DataFrame:
    """Source rows from the watermark on, the watermark included; a NULL event never loads.

    ``lookback_days`` moves the watermark back to catch late corrections; 0 is the rule of
    the warehouse. A source stored by month is pruned to the months that can qualify.
    """
    if lookback_days:
        moved = since - F.expr(f"INTERVAL {int(lookback_days)} DAYS")
        since = moved.cast(source.schema[event].dataType)
    rows = source.where(quoted(event) >= since)
    if MONTH in source.columns:
        rows = rows.where(F.col(MONTH) >= month_start(since))
    return rows


def shaped_for(rule, increment_rows: DataFrame, as_of: Column) -> DataFrame:
    """Increment rows as rows of the target: derived columns, renames, declared types."""
    old_names = {new: old for old, new in rule.renames.items()}
    return increment_rows.select(
        *[
            conform_column(
                c,
                rule.derived[c.name](as_of)
                if c.name in rule.derived
                else quoted(old_names.get(c.name, c.name)),
            )
            for c in rule.columns
        ]
    )


def is_changed(rule, target: str = "t", source: str = "s", skip: tuple[str, ...] = ()) -> Column:
    """Whether a matched pair differs in a compared column.

    A plain comparison with NULL is unknown, hence no change; the null-safe columns take
    NULL for an empty text. ``skip`` leaves columns out.
    """
    terms = [
        quoted(c, target) != quoted(c, source) for c in rule.compare if c not in skip
    ]
    terms += [
        F.coalesce(quoted(c, target), F.lit("")) != F.coalesce(quoted(c, source), F.lit(""))
        for c in rule.compare_null_safe
    ]
    return reduce(or_, terms)


def same_key(rule) -> Column:
    return quoted(rule.key, "t") == quoted(rule.key, "s")


def new_rows(rows: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Increment rows whose key the target does not have. Reads only the target's key."""
    return rows.join(target.select(quoted(key)), key, "left_anti")


def changed_pairs(
    target: DataFrame, rows: DataFrame, rule, skip: tuple[str, ...] = ()
) -> DataFrame:
    """Key and compared columns of target rows (as ``old_*``) that an increment row changes."""
    compared = [*rule.compare, *rule.compare_null_safe]
    return (
        target.select(quoted(rule.key), *map(quoted, compared))
        .alias("t")
        .join(rows.alias("s"), same_key(rule) & is_changed(rule, skip=skip))
        .select(
            quoted(rule.key, "s").alias(rule.key),
            *[quoted(c, "t").alias(f"old_{c}") for c in compared],
            *[quoted(c, "s").alias(c) for c in compared],
        )
    )


def updated(target: DataFrame, rows: DataFrame, rule) -> DataFrame:
    """Target rows, each with the values of the increment row that changes it, if any.

    Columns that are never updated keep the target's value.
    """
    taken = quoted(rule.key, "s").isNotNull()
    return (
        target.select(*map(quoted, rule.names))
        .alias("t")
        .join(rows.alias("s"), same_key(rule) & is_changed(rule), "left")
        .select(
            *[
                quoted(c, "t").alias(c)
                if c == rule.key or c in rule.never_updated
                else F.when(taken, quoted(c, "s")).otherwise(quoted(c, "t")).alias(c)
                for c in rule.names
            ]
        )
    )


def upsert_counts(target: DataFrame, rows: DataFrame, rule) -> DataFrame:
    """One row: how many rows the merge inserts and updates."""
    inserted = new_rows(rows, target, rule.key).agg(F.count(F.lit(1)).alias("n"))
    updated = changed_pairs(target, rows, rule).agg(F.count(F.lit(1)).alias("n"))
    return (
        inserted.withColumn("what", F.lit("rows_inserted"))
        .unionByName(updated.withColumn("what", F.lit("rows_updated")))
        .select("what", "n")
    )


def repeated_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return (
        rows.groupBy(*map(quoted, keys))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def changes_per_key(target: DataFrame, rows: DataFrame, rule, repeated: DataFrame | None = None) -> DataFrame:
    """For keys repeated in the increment: how many rows would change one target row, at most.

    Above one the upsert is ambiguous, at zero the repeats are mere copies. Pairs of target
    and increment rows are never formed, as a repeated key may hold very many rows on both
    sides. Both are reduced to distinct states of the compared columns, and the increment
    rows that agree with a state are counted; the others of the key change it. ``repeated``
    are the ``repeated_keys`` of the increment, if they are known.

    NULL agrees with anything. Where a key has no NULL in any state, only equal states agree, and
    those meet when both sides are grouped together. The states of the other keys are compared by
    ``_agreeing``.
    """
    compared = [*rule.compare, *rule.compare_null_safe]
    nullable = list(rule.compare)
    values = [f"v{i}" for i in range(len(compared))]
    repeated = repeated_keys(rows, rule.key) if repeated is None else repeated

    def states(df: DataFrame, n_rows: Column, is_held: bool) -> DataFrame:
        nulls = reduce(
            lambda a, b: a.bitwiseOR(b),
            [
                F.when(quoted(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
                for i, c in enumerate(nullable)
            ],
        )
        return df.join(repeated.select(quoted(rule.key)), rule.key, "left_semi").select(
            quoted(rule.key).alias("key"),
            nulls.alias("nulls"),
            *[
                F.coalesce(quoted(c).cast("string"), F.lit("")).alias(v)
                for c, v in zip(compared, values)
            ],
            n_rows.alias("n_rows"),
            F.lit(is_held).alias("held"),
        )

    known = (
        states(target, F.lit(0), True)
        .unionByName(states(rows, F.lit(1), False))
        .groupBy("key", "nulls", *values)
        .agg(F.sum("n_rows").alias("n_rows"), F.max("held").alias("held"))
    )
    by_key = (
        known.groupBy("key")
        .agg(
            F.sum("n_rows").alias("n_all"),
            F.min(F.when(F.col("held"), F.col("n_rows"))).alias("n_least"),
            F.bit_or("nulls").alias("any_null"),
        )
        .where(F.col("n_least").isNotNull())
    )
    without_nulls = by_key.where(F.col("any_null") == 0).select(
        "key", (F.col("n_all") - F.col("n_least")).alias("n_changes")
    )
    others = by_key.where(F.col("any_null") != 0).select("key", "n_all")
    with_nulls = (
        _agreeing(known.join(others, "key"), len(nullable), values)
        .groupBy("key")
        .agg(F.max(F.col("n_all") - F.col("n_agreeing")).alias("n_changes"))
    )
    return without_nulls.unionByName(with_nulls).select(F.col("key").alias(rule.key), "n_changes")


def _agreeing(known: DataFrame, n_nullable: int, values: list[str]) -> DataFrame:
    """For each held state of a key, with NULLs among the states: how many increment rows the key has
    (``n_all``, as in ``known``), and how many agree with the state.

    A column counts only where both sides have a value. Each state is listed once for every set
    of ignored columns (``ignored``, a bit each) that covers its own NULLs; two states meet where
    the set is just what their NULLs demand. Both sides ask for all that is known of a state, so that
    Spark finds one shuffle of the states and runs it once.
    """
    sets = F.array(*[F.lit(i) for i in range(1 << n_nullable)])

    def widened(df: DataFrame) -> DataFrame:
        listed = df.withColumn("ignored", F.explode(sets)).where(
            F.col("ignored").bitwiseAND(F.col("nulls")) == F.col("nulls")
        )
        seen = []
        for i, v in enumerate(values):
            value = F.col(v)
            if i < n_nullable:
                hidden = F.col("ignored").bitwiseAND(F.lit(1 << i)) != 0
                value = F.when(hidden, F.lit("")).otherwise(value)
            seen.append(value)
        return listed.withColumn("seen", F.array(*seen))

    held = known.where(F.col("held") & (F.col("n_rows") >= 0)).withColumn("state", F.struct("nulls", *values))
    meeting = (
        widened(held)
        .select("key", "state", "ignored", "seen", F.col("nulls").alias("held_nulls"))
        .join(
            widened(known.where((F.col("n_rows") > 0) & F.col("held").isNotNull()))
            .groupBy("key", "ignored", "seen", "nulls")
            .agg(F.sum("n_rows").alias("n_rows")),
            ["key", "ignored", "seen"],
        )
        .where(F.col("ignored") == F.col("held_nulls").bitwiseOR(F.col("nulls")))
        .groupBy("key", "state")
        .agg(F.sum("n_rows").alias("n_agreeing"))
    )
    return (
        held.select("key", "state", "n_all")
        .join(meeting, ["key", "state"], "left")
        .select("key", "n_all", F.coalesce("n_agreeing", F.lit(0)).alias("n_agreeing"))
    )


def ambiguous_keys(target: DataFrame, rows: DataFrame, rule) -> DataFrame:
    """Keys with a target row that more than one increment row would change."""
    return changes_per_key(target, rows, rule).where(F.col("n_changes") > 1)


def without_copies(rows: DataFrame, changes: DataFrame, rule) -> DataFrame:
    """Increment rows without those that repeat key and compared columns of another, for the
    keys of ``changes``.

    Where no target row is changed twice such copies change nothing, and as their key exists
    they are not new either. What is left of a key is at most a few rows.
    """
    compared = [*rule.compare, *rule.compare_null_safe]
    known = rows.join(changes.select(quoted(rule.key)), rule.key, "left_semi")
    copies = repeated_keys(known, rule.key, *compared)
    alike = reduce(
        lambda a, b: a & b,
        [quoted(c, "s").eqNullSafe(quoted(c, "c")) for c in compared],
        quoted(rule.key, "s") == quoted(rule.key, "c"),
    )
    return rows.alias("s").join(copies.alias("c"), alike, "left_anti")


def late_rows(source: DataFrame, target: DataFrame, key: str, event: str, since: Column) -> DataFrame:
    """Source rows older than the watermark that the target lacks; no load will take them."""
    return new_rows(source.where(quoted(event) < since), target, key)


# ---- corrections of old rows ------------------------------------------------------------

#: Keys of a range whose rows are compared as a whole first.
RANGE_KEYS = 65_536


def range_digests(df: DataFrame, rule, size: int = RANGE_KEYS) -> DataFrame:
    """Per month of the event and range of keys: how many rows, and a sum of hashes of all that a
    change can be seen by. Two tables agree in a range where both numbers do.

    Partial sums are made where the rows are read, so what is shuffled is a row per range and task.
    """
    compared = [rule.event, *rule.compare, *rule.compare_null_safe]
    seen = F.xxhash64(quoted(rule.key), *map(quoted, dict.fromkeys(compared)))
    return df.groupBy(
        month_start(quoted(rule.event)).alias(MONTH), key_range(rule, size).alias("key_range")
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(seen.cast("decimal(20,0)")).alias("digest"))


def key_range(rule, size: int = RANGE_KEYS) -> Column:
    return F.floor(quoted(rule.key) / F.lit(size)).cast("bigint")


def differing_ranges(source: DataFrame, target: DataFrame, rule, size: int = RANGE_KEYS) -> DataFrame:
    """Months and key ranges in which the rows of two tables differ, or only one has rows."""
    places = [MONTH, "key_range"]
    here = range_digests(source, rule, size).withColumnsRenamed({"n_rows": "n_source", "digest": "digest_source"})
    there = range_digests(target, rule, size)
    same = F.col("n_rows").eqNullSafe(F.col("n_source")) & F.col("digest").eqNullSafe(F.col("digest_source"))
    return here.join(there, places, "full").where(~same).select(*places)


def of_ranges(df: DataFrame, rule, ranges: DataFrame, months: list, size: int = RANGE_KEYS) -> DataFrame:
    """The rows in some ranges; a table stored by month is read in the given months only."""
    if MONTH not in df.columns:
        df = df.withColumn(MONTH, month_start(quoted(rule.event)))
    rows = df.where(F.col(MONTH).isin(months)).withColumn("key_range", key_range(rule, size))
    return rows.join(ranges, [MONTH, "key_range"], "left_semi")


def late_corrections(source: DataFrame, target: DataFrame, rule, since: Column, staged, size: int = RANGE_KEYS) -> DataFrame:
    """Source rows (in the target's shape) older than the watermark that would change a target row.

    No load takes them, as it starts at the watermark. Only ranges of keys in which source and target
    differ are compared row by row. ``staged`` writes the differing ranges and reads them back, so that
    digests are made once; their months come to the driver. The old values are given as ``old_*``.
    """
    older = source.where(quoted(rule.event) < since)
    ranges = staged(differing_ranges(older, target, rule, size))
    months = sorted(r[0] for r in ranges.where(F.col(MONTH).isNotNull()).select(MONTH).distinct().collect())
    compared = [*rule.compare, *rule.compare_null_safe]
    held = of_ranges(target, rule, ranges, months, size).select(quoted(rule.key), *map(quoted, compared))
    rows = of_ranges(older, rule, ranges, months, size)
    return (
        held.alias("t")
        .join(rows.alias("s"), same_key(rule) & is_changed(rule))
        .select(*[quoted(c, "s").alias(c) for c in rule.names], *[quoted(c, "t").alias(f"old_{c}") for c in compared])
    )
