"""The upsert against a row-by-row model of it, on made-up rows full of NULLs and repeats."""

import random
from dataclasses import dataclass
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import upsert
from tidemark.plans.specs import Column


@dataclass(frozen=True)
class Rule:
    key: str = "k"
    event: str = "day"
    compare: tuple = ("day", "amount")
    compare_null_safe: tuple = ("state",)
    never_updated: tuple = ("rate",)
    columns: tuple = (
        Column("k", "INT", True),
        Column("day", "DATE"),
        Column("amount", "INT"),
        Column("state", "VARCHAR(5)"),
        Column("rate", "INT"),
    )

    @property
    def names(self):
        return [c.name for c in self.columns]


RULE = Rule()
DDL = "k int, day date, amount int, state string, rate int"


def changes(t, s):
    differs = [a is not None and b is not None and a != b for a, b in zip(t[1:3], s[1:3])]
    return any(differs) or (t[3] or "") != (s[3] or "")


def model(target, rows):
    """The merge, or None where it is ambiguous."""
    out = []
    for t in target:
        hits = [s for s in rows if s[0] == t[0] and changes(t, s)]
        if len(hits) > 1:
            return None
        out.append((*hits[0][:4], t[4]) if hits else t)
    held = {t[0] for t in target}
    return out + [s for s in rows if s[0] not in held]


def made_up(rng, keys, n):
    return [
        (
            rng.choice(keys),
            date(2024, 1, rng.randint(1, 2)),
            rng.choice([1, 2, None]),
            rng.choice(["a", "", None]),
            rng.randint(0, 9),
        )
        for _ in range(n)
    ]


def merged(target, rows, rule):
    """The target after the upsert, of the two operators the loads are made of."""
    added = upsert.new_rows(rows, target, rule.key)
    return upsert.updated(target, rows, rule).unionByName(added.select(*rule.names))


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_merge_of_unique_keys(spark, seed):
    rng = random.Random(seed)
    target = list({r[0]: r for r in made_up(rng, range(40), 60)}.values())
    rows = list({r[0]: r for r in made_up(rng, range(20, 60), 60)}.values())
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(rows, DDL)
    assert ordered(merged(t, s, RULE).collect()) == ordered(model(target, rows))
    counted = {r.what: r.n for r in upsert.upsert_counts(t, s, RULE).collect()}
    held = {r[0]: r for r in target}
    assert counted == {
        "rows_inserted": sum(r[0] not in held for r in rows),
        "rows_updated": sum(r[0] in held and changes(held[r[0]], r) for r in rows),
    }


@pytest.mark.parametrize("seed", range(4))
def test_repeated_keys(spark, seed):
    rng = random.Random(seed)
    target, rows = made_up(rng, range(30), 40), made_up(rng, range(30), 60)
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(rows, DDL)
    expected = {}
    for key in {r[0] for r in rows}:
        of_key = [r for r in rows if r[0] == key]
        held = [r for r in target if r[0] == key]
        if len(of_key) > 1 and held:
            expected[key] = max(sum(changes(h, r) for r in of_key) for h in held)
    found = {r.k: r.n_changes for r in upsert.changes_per_key(t, s, RULE).collect()}
    assert found == expected
    # Without the ambiguous keys the merge is defined, and copies may be left out.
    bad = {k for k, n in expected.items() if n > 1}
    fine_target = [r for r in target if r[0] not in bad]
    fine_rows = [r for r in rows if r[0] not in bad]
    t, s = spark.createDataFrame(fine_target, DDL), spark.createDataFrame(fine_rows, DDL)
    known = upsert.changes_per_key(t, s, RULE)
    single = upsert.without_copies(s, known, RULE)
    assert ordered(merged(t, single, RULE).collect()) == ordered(model(fine_target, fine_rows))


def test_a_hot_key_on_both_sides_forms_no_pairs(spark):
    n = 200_000
    copies = spark.range(n).select(
        F.lit(1).alias("k"), F.lit("2024-01-01").cast("date").alias("day"),
        (F.col("id") % 2).cast("int").alias("amount"), F.lit("a").alias("state"), F.lit(0).alias("rate"),
    )
    found = upsert.changes_per_key(copies, copies, RULE).collect()
    assert [(r.k, r.n_changes) for r in found] == [(1, n // 2)]


def test_watermark_of_an_empty_table_and_increment(spark):
    empty = spark.createDataFrame([], DDL)
    assert upsert.watermark(empty, "day").first()[0] == date(1900, 1, 1)
    source = spark.createDataFrame(
        [(1, date(2024, 1, 1), 1, "a", 0), (2, None, 1, "a", 0), (3, date(2024, 1, 3), 1, "a", 0)], DDL
    )
    since = upsert.watermark_literal(source.where("k = 3"), "day")
    assert [r.k for r in upsert.increment(source, "day", since).collect()] == [3]
    assert [r.k for r in upsert.increment(source, "day", since, 2).orderBy("k").collect()] == [1, 3]
    late = upsert.late_rows(source, source.where("k = 3"), "k", "day", since)
    assert [r.k for r in late.collect()] == [1]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_small_increment_leaves_the_target_where_it_is(spark, tmp_path):
    """Wide target rows are not shuffled: the written increment is small enough to broadcast."""
    target = spark.range(1000).select(
        F.col("id").cast("int").alias("k"), F.current_date().alias("day"),
        F.lit(1).alias("amount"), F.lit("a").alias("state"), F.lit(0).alias("rate"),
    )
    target.write.parquet(str(tmp_path / "target"))
    target.limit(5).write.parquet(str(tmp_path / "rows"))
    target = spark.read.parquet(str(tmp_path / "target"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    plan = plan_of(upsert.updated(target, rows, RULE))
    assert "BroadcastHashJoin" in plan and "LeftOuter, BuildRight" in plan
    assert "Exchange hashpartitioning" not in plan


def test_a_literal_watermark_prunes_months_and_reaches_the_scan(spark, tmp_path):
    rows = spark.range(90).select(
        F.col("id").cast("int").alias("k"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
    ).withColumn(upsert.MONTH, F.trunc("day", "MM"))
    rows.write.partitionBy(upsert.MONTH).parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    since = upsert.watermark_literal(facts, "day")
    found = upsert.increment(facts, "day", since)
    plan = plan_of(found)
    assert "event_month#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(day,2024-03-30)" in plan
    assert [r.day for r in found.collect()] == [date(2024, 3, 30)]


@pytest.mark.parametrize("known", [False, True])
def test_only_keys_with_a_null_are_listed_by_ignored_columns(spark, known, monkeypatch):
    """A key without NULLs is judged by equal states alone; repeated keys may be given."""
    day = date(2024, 1, 1)
    target = spark.createDataFrame([(1, day, 1, "a", 0), (2, day, None, "a", 0), (3, day, 1, "a", 0)], DDL)
    rows = [(k, day, amount, "a", 0) for k, amounts in ((1, (1, 2, 3)), (2, (4, 5)), (3, (1, 1)), (4, (1, 2))) for amount in amounts]
    rows = spark.createDataFrame(rows, DDL)
    listed, real = [], upsert._agreeing
    monkeypatch.setattr(upsert, "_agreeing", lambda states, *rest: listed.append(states) or real(states, *rest))
    repeated = (upsert.repeated_keys(rows, "k"),) if known else ()
    found = upsert.changes_per_key(target, rows, RULE, *repeated)
    assert sorted(map(tuple, found.collect())) == [(1, 2), (2, 0), (3, 0)]
    assert {r.key for r in listed[0].collect()} == {2}
