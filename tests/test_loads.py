"""Loads against catalog tables."""

from dataclasses import astuple, replace
from datetime import date, datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from checks import standins
from checks.workbooks import workbook_bytes
from tests.conftest import when
from tidemark.operators import runlog, upsert
from tidemark.operators.upsert import MONTH
from tidemark.plans import loads
from tidemark.plans.specs import DEV, SPECS, TIERS
from tidemark.sources import commits, tables

pytestmark = pytest.mark.usefixtures("clean_catalog")

AS_OF = datetime(2024, 6, 30, 12)

# Raw type and plain value by declared type.
RAW = {
    "VARCHAR": ("string", "'x'"),
    "DECIMAL": ("double", "1.5D"),
    "INT": ("bigint", "1L"),
    "BIGINT": ("bigint", "1L"),
    "BOOLEAN": ("bigint", "1L"),
    "DATE": ("date", "DATE'2024-01-01'"),
    "TIMESTAMP_NTZ": ("timestamp_ntz", "TIMESTAMP_NTZ'2024-01-01'"),
}


def put_raw(spark, table, rows):
    """A raw table with the given values; columns not given get a plain one."""
    spec = DEV[table]
    kinds = {c.name: RAW[c.type.split("(")[0]] for c in spec.columns}
    given = list(rows[0])
    df = spark.createDataFrame(
        [tuple(r.values()) for r in rows], ", ".join(f"{n} {kinds[n][0]}" for n in given)
    )
    listed = [
        F.col(n) if n in given else F.expr(plain).alias(n) for n, (_, plain) in kinds.items()
    ]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {loads.RAW}")
    tables.overwrite(df.select(*listed).coalesce(1), f"{loads.RAW}.{spec.source}")


def sale(key, day, amount=10.0, status="paid", product="p1"):
    return {
        "Sales_ID": key,
        "Transaction_DateTime": day and when(day),
        "Total_Amount": amount,
        "Payment_Status": status,
        "Product_ID": product,
    }


def sales(spark, tier="dev"):
    rows = tables.table_rows(spark, SPECS[tier]["Sales"]).collect()
    return sorted((r[0], str(r[3])[:10], float(r[34]), r[14]) for r in rows)


def load_sales(spark, rows, as_of=AS_OF):
    put_raw(spark, "Sales", rows)
    done = loads.load(spark, "dev", "Sales", as_of=as_of)
    return done.RowsInserted, done.RowsUpdated


def test_sales_first_and_second_load(spark):
    first = [sale(1, "2024-01-05"), sale(2, "2024-02-10"), sale(3, "2024-03-20")]
    assert load_sales(spark, first) == (3, 0)
    assert load_sales(spark, first) == (0, 0)
    second = [
        sale(1, "2024-01-05", 99.0),  # older than the watermark: the correction is missed
        sale(2, "2024-04-01", 20.0),  # moves from February to April
        sale(3, "2024-03-20", 10.0, None),  # a change to NULL is none
        sale(4, "2024-03-20", 1.0),  # on the watermark
        sale(5, "2024-02-11", 1.0),  # late, never loaded
        sale(6, None, 1.0),  # without a date, never loaded
        sale(7, "2024-05-01", 10.005),
    ]
    assert load_sales(spark, second) == (2, 1)
    assert sales(spark) == [
        (1, "2024-01-05", 10.0, "paid"),
        (2, "2024-04-01", 20.0, "paid"),
        (3, "2024-03-20", 10.0, "paid"),
        (4, "2024-03-20", 1.0, "paid"),
        (7, "2024-05-01", 10.01, "paid"),
    ]
    # February is empty now and gone; a raw 10.005 is not seen as changed again.
    months = [r[0] for r in spark.table("dev_data.Sales").select(MONTH).distinct().collect()]
    assert sorted(months) == [date(2024, m, 1) for m in (1, 3, 4, 5)]
    assert load_sales(spark, second) == (0, 0)


def test_untouched_months_keep_their_files(spark):
    load_sales(spark, [sale(1, "2024-01-05"), sale(2, "2024-02-10")])
    january = {f for f in spark.table("dev_data.Sales").inputFiles() if "2024-01-01" in f}
    changed = [sale(2, "2024-02-10", 11.0), sale(3, "2024-02-11")]
    assert load_sales(spark, changed) == (1, 1)
    assert january and january <= set(spark.table("dev_data.Sales").inputFiles())
    assert sales(spark)[0] == (1, "2024-01-05", 10.0, "paid")


class Crash(BaseException):
    """Ends a load as the death of its driver would: nothing handles it."""


SHIFTED = [
    sale(1, "2024-01-05", 99.0),
    sale(2, "2024-03-10", 20.0),  # leaves February, which is empty then
    sale(3, "2024-03-20"),
    sale(4, "2024-03-21", 1.0),
    sale(5, "2024-01-06", 1.0),
    sale(6, "2024-04-01", 1.0),
    sale(7, "2024-05-01", 1.0),
]
STEPS = ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01", "2024-05-01"]


def load_shifted(spark):
    put_raw(spark, "Sales", SHIFTED)
    return loads.load_fact(spark, DEV["Sales"], as_of=AS_OF, lookback_days=100)


@pytest.mark.parametrize("fails_at, after", [(-1, False), (0, False), (1, True), (3, False), (4, False), (4, True), (5, False)])
def test_a_load_that_dies_between_two_switches_is_finished_by_the_next(spark, monkeypatch, fails_at, after):
    """fails_at: the step of the intent at which the driver dies, before or after taking it; -1: with the
    files written and no intent yet; 5: with all steps taken and the intent still there."""
    load_sales(spark, [sale(1, "2024-01-05"), sale(2, "2024-02-10"), sale(3, "2024-03-20")])
    taken, apply, rename, put = [], commits.apply, commits._rename, commits._put

    def dying(spark, spec, step):
        taken.append(step["month"])
        if after:
            apply(spark, spec, step)
        if len(taken) == fails_at + 1:
            raise Crash
        if not after:
            apply(spark, spec, step)

    def dying_put(spark, path, text=""):
        if fails_at == -1 and path.endswith(commits.INTENT):
            raise Crash
        put(spark, path, text)

    def dying_rename(files, old, new):
        if fails_at == 5 and str(new).endswith(commits.DONE):
            raise Crash
        rename(files, old, new)

    monkeypatch.setattr(commits, "apply", dying)
    monkeypatch.setattr(commits, "_put", dying_put)
    monkeypatch.setattr(commits, "_rename", dying_rename)
    with pytest.raises(Crash):
        load_shifted(spark)
    assert taken == STEPS[: fails_at + 1]
    monkeypatch.undo()
    again = load_shifted(spark)
    assert again == ((4, 2) if fails_at == -1 else (0, 0))
    assert [r[:3] for r in sales(spark)] == [(r["Sales_ID"], str(r["Transaction_DateTime"])[:10], r["Total_Amount"]) for r in SHIFTED]
    assert [str(m) for m in tables.partition_values(spark, "dev_data.Sales")] == [m for m in STEPS if m != "2024-02-01"]
    load_shifted(spark)
    left = Path(tables.location(spark, DEV["Sales"]).removeprefix("file:")) / "_loads"
    assert not [p.name for p in left.iterdir() if p.is_file() and not p.name.startswith(".")]
    files = {f.removeprefix("file://").removeprefix("file:") for f in spark.table("dev_data.Sales").inputFiles()}
    base = left.parent
    assert {str(p) for p in base.rglob("*.parquet")} == files


def test_files_of_half_a_step_are_moved_once(spark, monkeypatch):
    """A month that gains several files, and a driver that dies between two of them."""
    load_sales(spark, [sale(k, "2024-01-05") for k in range(4)])
    rename, moved = commits._rename, []

    def dying(files, old, new):
        if str(new).endswith(".parquet"):
            moved.append(str(new))
            if len(moved) == 2:
                raise Crash
        rename(files, old, new)

    monkeypatch.setattr(commits, "_rename", dying)
    new = tables.with_month(tables.table_rows(spark, DEV["Sales"]).withColumn("Sales_ID", F.col("Sales_ID") + 10), DEV["Sales"])
    with pytest.raises(Crash):
        commits.change_months(new.repartition(4, "Sales_ID"), DEV["Sales"])
    monkeypatch.undo()
    assert len(moved) == 2
    commits.settle(spark, DEV["Sales"])
    commits.settle(spark, DEV["Sales"])
    assert [r[0] for r in sales(spark)] == [0, 1, 2, 3, 10, 11, 12, 13]


def test_a_load_runs_few_jobs(spark):
    load_sales(spark, [sale(k, "2024-01-05") for k in range(20)])
    put_raw(spark, "Sales", [sale(k, "2024-01-05", 10.0 + k % 3) for k in range(10, 30)])
    context = spark.sparkContext
    context.setJobGroup("one load", "")
    loads.load_fact(spark, DEV["Sales"], as_of=AS_OF)
    jobs = context.statusTracker().getJobIdsForGroup("one load")
    context._jsc.clearJobGroup()
    # With adaptive execution every shuffle and broadcast of the five passes is a job of its own.
    assert len(jobs) <= 20, len(jobs)


def test_lookback_takes_late_corrections(spark):
    load_sales(spark, [sale(1, "2024-01-05"), sale(2, "2024-01-10")])
    put_raw(spark, "Sales", [sale(1, "2024-01-05", 99.0), sale(2, "2024-01-10")])
    assert loads.load_fact(spark, DEV["Sales"], as_of=AS_OF) == (0, 0)
    assert loads.load_fact(spark, DEV["Sales"], as_of=AS_OF, lookback_days=7) == (0, 1)
    assert sales(spark)[0][2] == 99.0


def test_shuffled_joins_load_the_same(spark):
    first = [sale(k, "2024-01-05") for k in range(20)]
    second = [sale(k, "2024-01-05", 10.0 + k % 3) for k in range(10, 30)]
    found = []
    for bounds in ({}, {"broadcast_keys": 0, "broadcast_bytes": 0}):
        spark.sql("DROP TABLE IF EXISTS dev_data.Sales")
        counts = []
        for rows in (first, second):
            put_raw(spark, "Sales", rows)
            counts.append(loads.load_fact(spark, DEV["Sales"], as_of=AS_OF, **bounds))
        found.append((counts, sales(spark)))
    assert found[0] == found[1]
    assert found[0][0] == [(20, 0), (10, 7)]


def test_buckets_spare_the_table_a_shuffle(spark):
    """Equal rows with and without buckets, by both joins, and a plan that shuffles the increment only."""
    first = [sale(k, f"2024-0{1 + k % 3}-05") for k in range(40)]
    second = [sale(k, f"2024-0{1 + k % 4}-05", 10.0 + k % 3) for k in range(20, 60)]
    found = []
    for buckets in (0, 4):
        for bounds in ({}, {"broadcast_keys": 0, "broadcast_bytes": 0}):
            spec = replace(DEV["Sales"], buckets=buckets)
            spark.sql("DROP TABLE IF EXISTS dev_data.Sales")
            counts = []
            for rows in (first, second):
                put_raw(spark, "Sales", rows)
                counts.append(loads.load_fact(spark, spec, as_of=AS_OF, lookback_days=400, **bounds))
            found.append((counts, sales(spark)))
    assert found[0] == found[1] == found[2] == found[3] and found[0][0][1][1] > 0
    assert [t.name for t in spark.catalog.listTables("dev_data") if t.name.startswith("load_")] == []
    rows = tables.staged(tables.table_rows(spark, spec), "increment")
    plan = loads._effects(spark.table("dev_data.Sales"), rows, spec, False)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 2, plan


def test_memory_size_counts_texts(spark):
    rows = spark.sql("SELECT repeat('x', 1000) AS a, CAST(NULL AS STRING) AS b, 1L AS c FROM range(50)")
    assert rows.agg(tables.total_size(rows)).first()[0] == 50 * (1000 + 3 * 16)
    assert rows.limit(0).agg(tables.total_size(rows)).first()[0] == 0


def test_two_changes_of_one_row_stop_the_load(spark):
    load_sales(spark, [sale(1, "2024-01-05"), sale(2, "2024-01-04")])
    before = sales(spark)
    with pytest.raises(RuntimeError, match="several rows would change one row, 1 keys, the first 1"):
        load_sales(spark, [sale(1, "2024-01-05", 11.0), sale(1, "2024-01-05", 12.0)])
    assert sales(spark) == before
    last = loads.log_rows(spark).orderBy(F.desc("LogID")).first()
    assert (last.Status, last.RowsInserted, last.RowsUpdated) == ("Error", 0, 0)


def test_copies_are_harmless_and_new_copies_are_all_inserted(spark):
    load_sales(spark, [sale(1, "2024-01-05")])
    copies = [sale(1, "2024-01-05"), sale(1, "2024-01-05"), sale(1, "2024-01-05", 15.0)]
    new = [sale(7, "2024-01-06"), sale(7, "2024-01-06")]
    assert load_sales(spark, copies + new) == (2, 1)
    assert [r[:3] for r in sales(spark)] == [
        (1, "2024-01-05", 15.0),
        (7, "2024-01-06", 10.0),
        (7, "2024-01-06", 10.0),
    ]


def test_a_null_key_stops_the_load(spark):
    with pytest.raises(RuntimeError, match="Sales_ID: NULL in a NOT NULL column"):
        load_sales(spark, [sale(None, "2024-01-05")])


def test_failed_refresh_keeps_the_old_rows(spark):
    def products(*rows):
        put_raw(spark, "Products", [{"Product_ID": k, "Product_Name": n} for k, n in rows])

    def held():
        return sorted(r.Product_ID for r in spark.table("dev_data.Products").collect())

    products(("p1", "one"))
    assert loads.load(spark, "dev", "Products").RowsInserted == 1
    products(("p2", "n" * 256))
    with pytest.raises(RuntimeError, match="Product_Name: text longer than VARCHAR"):
        loads.load(spark, "dev", "Products")
    assert held() == ["p1"]
    products(("p3", "three"), ("p4", "four"))
    assert loads.load(spark, "dev", "Products").RowsInserted == 2
    assert held() == ["p3", "p4"]
    folder = Path(spark.table("dev_data.Products").inputFiles()[0].removeprefix("file:")).parent
    assert len(list(folder.parent.glob("version=*"))) == 2
    tables.drop_old_versions(spark, DEV["Products"])
    assert list(folder.parent.glob("version=*")) == [folder]
    assert held() == ["p3", "p4"]


def test_refreshes_keep_so_many_versions(spark):
    put_raw(spark, "Accounts", [{"Account_ID": "a"}])
    spec = DEV["Accounts"]
    for keep, left in ((3, 1), (3, 2), (3, 3), (3, 3), (2, 2), (1, 1)):
        rows = spark.table(f"{loads.RAW}.{spec.source}").select(*spec.names)
        assert tables.replace_rows(rows, spec, keep).get["n"] == 1
        base = Path(tables.location(spark, spec).removeprefix("file:")).parent
        assert len(list(base.glob("version=*"))) == left
        assert tables.table_rows(spark, spec).count() == 1


def test_all_tiers(spark):
    for name, spec in DEV.items():
        put_raw(spark, name, [{spec.key: 1 if spec.is_fact or name == "Date" else "a1"}])
    put_raw(
        spark, "Sales", [sale(1, "2024-06-01", product="a1"), sale(2, "2024-06-20", product="a1")]
    )
    for tier in TIERS:
        outcomes = loads.run_tier(spark, tier, as_of=AS_OF)
        assert {o.Status for o in outcomes} == {"Success"}, [o.ErrorMessage for o in outcomes]
        rows = {o.ProcedureName: o.RowsInserted for o in outcomes}
        assert rows == {name: 2 if name.endswith("sales") else 1 for name in rows}
        assert len(rows) == 13
        for spec in SPECS[tier].values():
            assert tables.table_rows(spark, spec).count() == (2 if spec.table == "Sales" else 1)
    row = spark.table("prod_data.Sales").where("Sales_ID = 1").first()
    assert row["Days Outstanding"] == row["Delivery Days"] == 29
    assert spark.table("prod_data.Products").first()["Launch Date"] == when("2024-06-01")
    assert spark.table("prod_data.Purchases").first()["Approval Date"] == when("2024-01-03")
    assert spark.table("prod_data.Employees").first()["Location"] == "x"
    star = spark.table("prod_data.Sales").alias("s").join(
        spark.table("prod_data.Products").alias("p"), F.expr("s.Product_ID = p.`Product Code`")
    )
    assert star.count() == 2
    log = loads.log_rows(spark).orderBy("LogID").collect()
    assert len({r.LogID for r in log}) == len(log) == 39
    assert [r.StartTime for r in log] == sorted(r.StartTime for r in log)
    assert log[0].ProcedureName == "pr_dev_fact_budget" and log[0].StartTime.microsecond == 0


def test_derived_columns_freeze_until_the_row_changes(spark):
    load_sales(spark, [sale(1, "2024-06-01"), sale(2, "2024-06-01")])
    loads.load(spark, "test", "Sales", as_of=datetime(2024, 6, 11))
    load_sales(spark, [sale(1, "2024-06-01"), sale(2, "2024-06-01", 12.0)])
    loads.load(spark, "test", "Sales", as_of=datetime(2024, 6, 21))
    rows = spark.table("test_data.Sales").orderBy("Sales_ID").collect()
    assert [r.Days_Outstanding for r in rows] == [10, 20]


def test_hr_rate_stays(spark):
    def load_hr(rate, amount):
        day = date(2024, 1, 1)
        row = {"HR_ID": 1, "Processing_Date": day, "Hourly_Rate": rate, "Net_Amount": amount}
        put_raw(spark, "Hr", [row])
        return loads.load(spark, "dev", "Hr")

    load_hr(5.0, 100.0)
    assert load_hr(6.0, 120.0).RowsUpdated == 1
    row = spark.table("dev_data.Hr").first()
    assert (float(row.Hourly_Rate), float(row.Net_Amount)) == (5.0, 120.0)


def test_a_failing_load_does_not_stop_a_tier(spark):
    put_raw(spark, "Accounts", [{"Account_ID": "a"}])
    outcomes = loads.run_tier(spark, "dev", as_of=AS_OF)
    status = {o.ProcedureName: o.Status for o in outcomes}
    assert len(status) == 13
    assert status["pr_dev_dim_accounts"] == "Success"
    assert status["pr_dev_fact_sales"] == "Error"


def test_a_log_that_cannot_be_written_does_not_stop_a_tier(spark, monkeypatch):
    def refuse(*_):
        raise OSError("log is full")

    monkeypatch.setattr(loads, "append_log", refuse)
    put_raw(spark, "Accounts", [{"Account_ID": "a"}])
    outcomes = loads.run_tier(spark, "dev", as_of=AS_OF)
    assert len(outcomes) == 13
    assert {o.LogError for o in outcomes} == {"OSError: log is full"}
    assert tables.table_rows(spark, DEV["Accounts"]).count() == 1


def test_the_log_is_kept_by_the_clock_and_loads_look_back(spark):
    load_sales(spark, [sale(1, "2024-01-05"), sale(2, "2024-01-10")])
    put_raw(spark, "Sales", [sale(1, "2024-01-05", 99.0), sale(2, "2024-01-10")])
    done = loads.load(spark, "dev", "Sales", as_of=datetime(2199, 1, 1), lookback_days=7)
    assert (done.RowsUpdated, done.LogError) == (1, None)
    assert loads.log_rows(spark).count() == 2


def test_log_retention(spark):
    def outcome(start):
        return loads.Outcome("dev_data", "p", when(start), AS_OF, 1, 0, "Success", None)

    edge = outcome("2024-05-21 12:00:00")
    loads.append_log(spark, [outcome("2024-05-21 11:59:59"), edge, outcome("2024-05-01")])
    loads.retain_log(spark, AS_OF)
    assert [r.StartTime for r in loads.log_rows(spark).collect()] == [edge.StartTime]
    loads.append_log(spark, [edge])
    assert len({r.LogID for r in loads.log_rows(spark).collect()}) == 2


def test_interleaved_appends_give_distinct_ids(spark, monkeypatch):
    """Two applications, and two sessions of one, that log the same second without seeing each other."""
    same = [loads.Outcome("dev_data", f"p{i}", when("2024-05-21 12:00:00"), AS_OF, 1, 0, "Success", None) for i in range(3)]
    batch = spark.createDataFrame([astuple(o)[:-1] for o in same], loads.OUTCOME_DDL)
    here, there = (runlog.application_number(x) for x in ("app-1", "app-2"))
    appends = [runlog.outcome_rows(batch, a, runlog.reserved(3)) for a in (here, here, there)] + [runlog.outcome_rows(batch, there, 0)]
    assert len({r.LogID for df in appends[:3] for r in df.collect()}) == 9
    assert len({r.LogID for df in appends[1:] for r in df.collect()}) == 9
    later = runlog.outcome_rows(batch.withColumn("StartTime", F.expr("StartTime + INTERVAL 1 SECOND")), there, 65_535)
    assert min(r.LogID for r in later.collect()) > max(r.LogID for df in appends for r in df.collect())
    assert "SinglePartition" not in appends[0]._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in runlog.appended(loads_log(spark), batch)._jdf.queryExecution().executedPlan().toString()


def loads_log(spark):
    loads.create_log(spark)
    return loads.log_rows(spark)


def test_corrections_of_any_age(spark):
    first = [sale(1, "2024-01-05"), sale(2, "2024-02-10"), sale(3, "2024-03-20"), sale(4, "2024-01-06")]
    load_sales(spark, first)
    put_raw(spark, "Sales", [sale(1, "2024-01-05", 99.0), sale(2, "2024-01-11"), sale(3, "2024-03-20"), sale(4, "2024-01-06", 10.0, None), sale(9, "2024-01-01")])
    assert loads.load_fact(spark, DEV["Sales"], as_of=AS_OF) == (0, 0)
    # The late row 9 is none of them, nor is a change to NULL.
    assert loads.load_fact(spark, DEV["Sales"], as_of=AS_OF, corrections=True) == (0, 2)
    assert [r[:3] for r in sales(spark)] == [(1, "2024-01-05", 99.0), (2, "2024-01-11", 10.0), (3, "2024-03-20", 10.0), (4, "2024-01-06", 10.0)]
    assert loads.load_fact(spark, DEV["Sales"], as_of=AS_OF, corrections=True) == (0, 0)


def test_only_differing_ranges_are_compared(spark):
    spec = DEV["Sales"]
    load_sales(spark, [sale(k, f"2024-0{1 + k // 100}-05") for k in range(400)])
    target = spark.table("dev_data.Sales")
    rows = tables.table_rows(spark, spec)
    source = rows.withColumn("Total_Amount", F.when(F.col("Sales_ID") == 123, F.lit(5).cast("decimal(18,2)")).otherwise(F.col("Total_Amount")))
    ranges = upsert.differing_ranges(source, target, spec, size=10).collect()
    assert [(str(r[0]), r[1]) for r in ranges] == [("2024-02-01", 12)]
    since = F.lit("2024-12-01").cast("timestamp_ntz")
    staged = lambda df: tables.staged(df, "ranges")
    found = upsert.late_corrections(source, target, spec, since, staged, size=10)
    assert [(r.Sales_ID, float(r.Total_Amount), float(r.old_Total_Amount)) for r in found.collect()] == [(123, 5.0, 10.0)]
    part = upsert.of_ranges(target, spec, staged(spark.createDataFrame(ranges)), [ranges[0][0]], size=10)
    assert sorted(r.Sales_ID for r in part.collect()) == list(range(120, 130))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "2024-02-01" in plan


def test_workbooks_to_raw_tables(spark, tmp_path):
    content = workbook_bytes(
        {
            "DIM Accounts": [["Account ID", "Account-Name"], ["a1", "Cash"], ["a2", None]],
            "FACT_Sales": [["Sales_ID", "Total Amount (RON)"], [1, 2.5], [2, 3]],
            "Clash": [["a b", "a_b"], [1, 2]],
            "Empty": [],
            "Twin 1": [["h"], [1]],
            "Twin-1": [["h"], [2]],
        }
    )
    (tmp_path / "model.xlsx").write_bytes(content)
    (tmp_path / "broken.xlsx").write_bytes(b"no zip")
    outcomes = loads.ingest_workbooks(spark, str(tmp_path))
    by_name = {o.ProcedureName.split("/")[-1]: o for o in outcomes}
    assert by_name["broken.xlsx"].Status == "Error"
    assert by_name["raw_data.dim_accounts"].RowsInserted == 2
    assert "equal after cleaning" in by_name["raw_data.clash"].ErrorMessage
    assert "no sheet Empty" in by_name["raw_data.empty"].ErrorMessage
    assert "2 sheets" in by_name["raw_data.twin_1"].ErrorMessage
    sold = spark.table("raw_data.FACT_Sales")
    assert dict(sold.dtypes) == {"Sales_ID": "bigint", "Total_Amount_RON": "double"}
    again = loads.ingest_workbooks(spark, str(tmp_path), overwrite=False)
    assert {o.Status for o in again} == {"Error"}


def test_a_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path.*not.*exist"):
        loads.ingest_workbooks(spark, str(tmp_path / "none"))


def test_cluster_without_a_shared_folder():
    conf = SimpleNamespace(get=lambda *_: None)

    def session(master):
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master=master, applicationId="test"))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            tables.shared_folder(session(master))
    for master in ("local", "local[*]", "local[8]"):
        assert tables.shared_folder(session(master)) == tables.shared_folder(session("local[2]"))

def test_rows_that_lie_by_month_are_known(spark, tmp_path):
    """Files of one month each may be written as they lie; files that mix years may not."""
    days = "date_add(DATE'2000-01-15', CAST(id % 24 AS INT) * 31)"
    rows = spark.range(0, 240, 1, 4).select("id", F.expr(days).cast("timestamp_ntz").alias("Transaction_DateTime"))
    rows.write.parquet(f"{tmp_path}/mixed")
    rows.repartitionByRange(24, "Transaction_DateTime").write.parquet(f"{tmp_path}/dealt")
    assert tables.lies_by_month(spark.read.parquet(f"{tmp_path}/dealt"), DEV["Sales"])
    assert not tables.lies_by_month(spark.read.parquet(f"{tmp_path}/mixed"), DEV["Sales"])


def test_wide_rows_of_an_increment_are_not_shuffled_to_be_compared(spark):
    """Only key, compared columns and month are read of an increment until its rows are written."""
    spec = DEV["Purchases"]
    columns = ", ".join(f"`{c.name}` {'STRING' if c.max_length else c.type}" for c in spec.columns)
    rows = spark.createDataFrame([], columns)
    held = rows.select(*loads._compared(spec)).withColumn(MONTH, F.lit(None).cast("date"))
    effects = loads._effects(rows, held, spec, False)
    assert effects.columns == [spec.key, MONTH, loads.ADDS]
    assert loads._held(rows.withColumn(MONTH, F.lit(None).cast("date")), rows, spec, False).columns == [*loads._compared(spec), MONTH]


def test_a_stand_in_target_is_filled_without_dealing_out_its_forty_columns(spark, sf):
    """The few columns it is projected from lie by month; the rows are those of the SQL."""
    spec = DEV["Purchases"]
    lying = standins.target(spark, sf, spec, standins.fact_rows(spark, sf, spec))
    assert "hashpartitioning" not in lying._jdf.queryExecution().executedPlan().toString()
    plain = standins.target(spark, sf, spec)
    assert lying.exceptAll(plain).isEmpty() and plain.exceptAll(lying).isEmpty()


def test_new_months_of_an_increment_are_written_once(spark, monkeypatch):
    """Rows of months in which all are new join the table as the files they were staged in; only other
    months are written again, also where a row moves into a new month."""
    load_sales(spark, [sale(1, "2024-01-05"), sale(2, "2024-02-10")])
    write, again = tables.write_months, []

    def seen(rows, *args):
        again.extend(str(r[0]) for r in rows.select(MONTH).distinct().collect())
        write(rows, *args)

    monkeypatch.setattr(tables, "write_months", seen)
    second = [sale(1, "2024-04-05"), sale(2, "2024-02-10"), sale(3, "2024-02-11"), sale(4, "2024-03-01"), sale(5, "2024-03-02")]
    assert load_sales(spark, second) == (3, 1)
    assert sorted(again) == ["2024-02-01", "2024-04-01"]
    assert [r[:2] for r in sales(spark)] == [(r["Sales_ID"], str(r["Transaction_DateTime"])[:10]) for r in second]
    again.clear()
    third = [sale(3, "2024-05-01"), sale(6, "2024-06-01"), sale(7, "2024-06-02")]
    assert load_sales(spark, third) == (2, 1)
    assert "2024-06-01" not in again
    assert load_sales(spark, third) == (0, 0)
    assert len(sales(spark)) == 7
    left = Path(tables.location(spark, DEV["Sales"]).removeprefix("file:")) / "_loads"
    assert not [p.name for p in left.iterdir() if p.name.endswith((commits.ASIDE, commits.WRITING))]


def test_rows_that_facts_are_projected_from_have_no_column_more(spark, sf):
    spec = DEV["Inventory"]
    rows = spark.sql(standins.fact_rows(spark, sf, spec))
    assert {"party", "line"}.isdisjoint(rows.columns) and {"k", "day", "quantity"} <= set(rows.columns)
