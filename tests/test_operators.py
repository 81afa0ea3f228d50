"""Rules that decide results, on hand-made rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from tests.conftest import when
from tidemark.functions import errors
from tidemark.functions.dates import days_between, moment, plus_days
from tidemark.functions.names import business_name, clean_headers, table_name
from tidemark.operators import runlog, timeseries
from tidemark.operators.conform import conform, inferred_types, with_inferred_types
from tidemark.operators.refresh import with_first_event
from tidemark.plans.specs import Column
from tidemark.sources import samples, tables

CASES = (
    "continent string, location string, date date, population double, total_cases double, "
    "new_cases double, total_deaths string, new_deaths string"
)


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


# ---- names, dates, types ----------------------------------------------------------------


def test_names():
    assert clean_headers(["a b", "c-d", "e (f)", "g/h.i", 5]) == ["a_b", "c_d", "e_f", "g_h_i", "5"]
    with pytest.raises(ValueError, match=r"\['a b', 'A-b'\]"):
        clean_headers(["a b", "A-b", "c"])
    assert table_name("FACT Sales-2024 (x)", "raw_") == "raw_FACT_Sales_2024_(x)"
    assert business_name("Day_of_Week", "Date_ID") == "Day of Week"
    assert business_name("Business_Line_ID", "Business_Line_ID") == "Business Line Code"
    assert business_name("Account_ID") == "Account_ID"


def test_dates(spark):
    a, b = moment(when("2024-03-30 23:59:00")), moment(when("2024-03-31 00:01:00"))
    assert one(spark, days_between(a, b)) == 1
    # 03:30 does not exist on that day in the session's time zone.
    assert one(spark, plus_days(moment(when("2024-03-29 03:30:00")), 2)) == when("2024-03-31 03:30:00")
    assert one(spark, runlog.to_second(moment(when("2024-03-31 03:30:59.500000")))) == when("2024-03-31 03:31:00")
    assert one(spark, runlog.to_second(moment(when("2024-03-31 03:30:59.499999")))) == when("2024-03-31 03:30:59")


def test_conform_casts(spark):
    df = spark.createDataFrame([(7.9, 2.345, 1, "abc")], "n double, d double, b bigint, t string")
    columns = (Column("n", "INT", True), Column("d", "DECIMAL(38,2)"), Column("b", "BOOLEAN"), Column("t", "VARCHAR(3)"))
    row = conform(df, columns).first()
    assert tuple(row) == (7, Decimal("2.35"), True, "abc")
    with pytest.raises(Exception, match="t: text longer than VARCHAR"):
        conform(df, [Column("t", "VARCHAR(2)")]).collect()
    with pytest.raises(Exception, match="n: NULL in a NOT NULL"):
        conform(df.withColumn("n", F.lit(None)), columns).collect()


def test_inferred_types(spark):
    df = spark.createDataFrame(
        [("1", "1", "2024-01-01", "x", None), (None, "2.5", "2024-01-02 10:00:00", "1", None), ("-3", "1e3", None, "2", None)],
        "i string, d string, t string, s string, e string",
    )
    found = {r.column_name: (r.n_values, r.inferred_type) for r in inferred_types(df).collect()}
    assert found == {"i": (2, "bigint"), "d": (3, "double"), "t": (2, "timestamp_ntz"), "s": (3, "string"), "e": (0, "string")}
    assert [t for _, t in with_inferred_types(df).dtypes] == ["bigint", "double", "timestamp_ntz", "string", "string"]


def test_first_event_keeps_rows_without_one(spark):
    products = spark.createDataFrame([("a",), ("b",)], "k string")
    sales = spark.createDataFrame([("a", date(2024, 1, 2)), ("a", date(2024, 1, 1))], "k string, d date")
    found = with_first_event(products, sales, "k", "d", "first").orderBy("k").collect()
    assert [tuple(r) for r in found] == [("a", date(2024, 1, 1)), ("b", None)]


# ---- time series ------------------------------------------------------------------------


def test_running_total_over_joined_rows(spark):
    """Several rows a day on both sides, NULL doses, and a place with most of the rows."""
    d = [date(2024, 1, i) for i in (1, 2, 3)]
    cases = [("X", "hot", day, 10.0, 1.0, 1.0, "1", "1") for day in d for _ in range(3)]
    cases += [("Y", "cold", d[0], 10.0, 1.0, 1.0, "1", "1"), (None, "all", d[0], 10.0, 1.0, 1.0, "1", "1")]
    doses = [("hot", d[0], None), ("hot", d[1], "5"), ("hot", d[1], "6"), ("hot", d[2], "1"), ("cold", d[0], "2"), ("all", d[0], "9")]
    c = spark.createDataFrame(cases, CASES)
    v = spark.createDataFrame(doses, "location string, date date, new_vaccinations string")
    plain = (
        c.where("continent IS NOT NULL").join(v, ["location", "date"])
        .withColumn("total", F.sum(F.col("new_vaccinations").cast("bigint")).over(Window.partitionBy("location").orderBy("location", "date")))
        .select("continent", "location", "date", "population", "new_vaccinations", "total")
    )
    found = timeseries.running_vaccinations(c, v)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, map(tuple, plain.collect())))
    with pytest.raises(TypeError, match="must be a DATE"):
        timeseries.running_by_day(c.withColumn("date", F.col("date").cast("timestamp")), "location", "date", "new_cases", "x")


def test_shares_and_highest(spark):
    rows = [
        ("X", "a", date(2024, 1, 1), 100.0, 0.0, 0.0, "9", "0"),
        ("X", "a", date(2024, 1, 2), 100.0, 50.0, 50.0, "10", "1"),
        (None, "W", date(2024, 1, 2), 0.0, 50.0, 50.0, "7", "7"),
    ]
    c = spark.createDataFrame(rows, CASES)
    assert [r.DeathPercentage for r in timeseries.death_percentage(c, "%a%").collect()] == [None, 20.0]
    # Compared as numbers, not as text.
    assert timeseries.deaths_by_location(c).first().TotalDeathCount == 10
    assert [tuple(r) for r in timeseries.deaths_by_aggregate(c).collect()] == [("W", 7)]
    total = timeseries.global_population(c).first()
    assert (total.GlobalPopulation, total.GlobalInfectedPopulation) == (200.0, 25.0)
    assert timeseries.global_numbers(c.where("false")).count() == 1
    bad = c.withColumn("total_deaths", F.lit("12.5"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        timeseries.highest_deaths(bad, "location").collect()
    assert timeseries.highest_deaths(bad, "location", lenient=True).first().TotalDeathCount is None


# ---- run log and error lists ------------------------------------------------------------

LOG_AS_OF = when("2024-05-01 12:00:00")


def log(spark, *rows):
    full = [(i, s, p, when(t), when(t), 0, 0, st, m) for i, (s, p, t, st, m) in enumerate(rows, 1)]
    return spark.createDataFrame(full, runlog.LOG_DDL)


def test_digest_and_report(spark):
    df = log(
        spark,
        ("dev_data", "p2", "2024-05-01 10:00:30", "Error", "second"),
        ("dev_data", "p1", "2024-05-01 10:00:10", "Error", "first"),
        ("dev_data", "p3", "2024-05-01 09:00:00", "Error", "edge"),
        ("dev_data", "p0", "2024-05-01 08:59:59", "Error", "too old"),
        ("dev_data", "p4", "2024-05-01 11:00:00", "Error", None),
        ("dev_data", "p5", "2024-05-01 11:00:00", "Success", "fine"),
        ("prod_data", "q", "2024-05-01 11:00:00", "Error", "bad"),
        ("test_data", "t", "2024-05-01 11:00:00", "Error", None),
    )
    digest = {r.SchemaName: r.errors for r in runlog.error_digest(df, moment(LOG_AS_OF)).collect()}
    assert digest == {"dev_data": "p3: edge\rp1: first\rp2: second", "prod_data": "q: bad", "test_data": None}
    report = runlog.error_report(df, moment(LOG_AS_OF)).first()[0]
    assert report == "DEV:\rp3: edge\rp1: first\rp2: second\r\rPROD:\rq: bad"
    shown = runlog.error_digest(df, moment(LOG_AS_OF), show_unknown=True).where("SchemaName = 'test_data'")
    assert shown.first().errors == "t: unknown error"
    assert runlog.error_report(df.where("false"), moment(LOG_AS_OF)).first()[0] == ""


def test_append_and_retention(spark):
    df = log(spark, ("dev_data", "p", "2024-03-22 12:00:00", "Success", None), ("dev_data", "p", "2024-03-22 11:59:59", "Success", None))
    assert [r.LogID for r in runlog.retained(df, moment(LOG_AS_OF)).collect()] == [1]
    unknown = df.withColumn("StartTime", F.lit(None).cast("timestamp_ntz"))
    assert runlog.retained(unknown, moment(LOG_AS_OF)).count() == 2
    batch = df.select(*runlog.LOG_COLUMNS[1:]).withColumn("ErrorMessage", F.repeat(F.lit("x"), F.lit(5000)))
    added = runlog.appended(df, batch).orderBy("LogID").collect()
    assert [r.LogID for r in added] == [1, 2, 3, 4] and len(added[-1].ErrorMessage) == 4000
    assert runlog.appended(df.where("false"), batch).agg(F.min("LogID")).first()[0] == 1


@pytest.mark.parametrize("text", ["", "  ", "[]", " [] ", "DEV:\rp: x", '{"SchemaName": "x"}', '[{"a": "b"', "[1, 2]", '[{"SchemaName": "s"}] xyz', '[{"SchemaName": "s"}], 1', "[{'SchemaName': 's'}]", '[{"a": "b"}]]', None])
def test_no_errors_to_report(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert errors.error_rows(df, "t").count() == 0
    assert errors.error_reports(df, "t", moment(LOG_AS_OF)).first().report is None


@pytest.mark.parametrize("around", ["", "\n", "\t \r\n"])
def test_white_space_around_errors(spark, around):
    df = spark.createDataFrame([(around + '[{"SchemaName": "s"}]' + around,)], "t string")
    assert [r.SchemaName for r in errors.error_rows(df, "t").collect()] == ["s"]


def test_error_report(spark):
    text = '[{"SchemaName": "test_data", "ProcedureName": "p", "Status": "Error", "ErrorMessage": "m", "StartTime": "a", "EndTime": "b"}, {"Status": null}]'
    df = spark.createDataFrame([(text,)], "t string")
    assert [tuple(r) for r in errors.error_rows(df, "t").collect()] == [
        (1, "test_data", "p", "Error", "m", "a", "b"),
        (2, "N/A", "N/A", "None", "N/A", "N/A", "N/A"),
    ]
    report = errors.error_reports(df, "t", moment(LOG_AS_OF)).first().report
    lines = report.split("\n")
    assert lines[0] == "=" * 65 and lines[-1] == "" and lines[-2] == "=" * 65
    assert "  Timestamp:    2024-05-01 12:00:00" in lines
    assert "  Total Errors: 2" in lines
    assert lines[lines.index("  Error #1") :][:8] == [
        "  Error #1", "  Schema:       test_data", "  Procedure:    p", "  Status:       Error",
        "  Error Msg:    m", "  Start Time:   a", "  End Time:     b", "-" * 65,
    ]


# ---- tables -----------------------------------------------------------------------------


@pytest.mark.usefixtures("clean_catalog")
def test_table_sinks(spark):
    spark.sql("CREATE DATABASE sinks")
    tables.create_only(spark.range(3), "sinks.t")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.create_only(spark.range(3), "sinks.t")
    tables.overwrite(spark.createDataFrame([("a", 1.5)], "s string, d double"), "sinks.t")
    assert dict(spark.table("sinks.t").dtypes) == {"s": "string", "d": "double"}
    spark.sql("CREATE TABLE sinks.typed (name STRING, n DECIMAL(18,0)) USING parquet")
    tables.append_by_position(spark.createDataFrame([("a", 2.5)], "x string, y double"), "sinks.typed")
    assert [tuple(r) for r in spark.table("sinks.typed").collect()] == [("a", Decimal(3))]
    row = tables.profile(spark.table("sinks.t"), "t").first()
    assert tuple(row) == ("t", 1, 2, "s, d")
    assert tables.preview(spark.range(9)).count() == 3
    assert samples.sample(spark.range(9)).count() == 5


def test_shared_folder_is_the_clusters(spark):
    assert tables.staging_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/")


def test_sales_by_date(spark):
    df = spark.createDataFrame([(d, 1.0, 0.5) for d in range(15)], "Date_ID int, Total_Amount double, Profit_Amount double")
    assert [r.Date_ID for r in samples.sales_by_date(df).collect()] == list(range(14, 4, -1))
    assert samples.sales_by_date(df, None).count() == 15
