"""The registered queries: each operator over the stand-ins, whole tables throughout."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import standins
from checks.workbooks import table_workbooks
from tidemark.functions import errors
from tidemark.functions.dates import days_between, moment, plus_days
from tidemark.functions.names import normalize_headers, table_name_column
from tidemark.operators import runlog, timeseries, upsert
from tidemark.operators.conform import conform, inferred_types, quoted
from tidemark.operators.refresh import refreshed, with_first_event
from tidemark.plans import loads
from tidemark.plans.specs import DEV, SPECS, TIERS, TableSpec
from tidemark.session import tuned
from tidemark.sources import samples, tables, workbook

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2002, 1, 1, 9, 30)
DIGEST_AS_OF = datetime(2024, 1, 31)
RETENTION_AS_OF = datetime(2024, 2, 20)
PLACE = "%NATION_1%"
UNSOLD_BRAND = "Brand#1"


def _own_database(spark: SparkSession, name: str) -> None:
    """An empty database in the shared folder.

    The next run of the same query drops it, so a result is to be used before.
    """
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tables.staging_path(spark, name)}'")


# ---- time series ------------------------------------------------------------------------


def _cases(spark: SparkSession, sf: str) -> DataFrame:
    return standins.frame(spark, sf, standins.COVID_DEATHS)


def _doses(spark: SparkSession, sf: str) -> DataFrame:
    return standins.frame(spark, sf, standins.COVID_VACCINATIONS)


def running_vaccinations(spark: SparkSession, sf: str) -> DataFrame:
    report = timeseries.running_vaccinations(_cases(spark, sf), _doses(spark, sf))
    return report.orderBy("location", "date")


def covid_cte(spark: SparkSession, sf: str) -> DataFrame:
    report = timeseries.vaccination_report(_cases(spark, sf), _doses(spark, sf))
    return timeseries.with_vaccinated_percentage(report)


def covid_temp_table(spark: SparkSession, sf: str) -> DataFrame:
    """The report inserted by position into a typed table that is made anew."""
    _own_database(spark, "check_report")
    name = "check_report.percent_population_vaccinated"
    tables.recreate(spark, name, dict(zip(timeseries.REPORT_COLUMNS, timeseries.REPORT_TYPES)))
    tables.append_by_position(
        timeseries.running_vaccinations(_cases(spark, sf), _doses(spark, sf)), name
    )
    return timeseries.with_vaccinated_percentage(spark.table(name))


def covid_view(spark: SparkSession, sf: str) -> DataFrame:
    report = timeseries.running_vaccinations(_cases(spark, sf), _doses(spark, sf))
    report.createOrReplaceTempView("vaccinations_by_place")
    return spark.sql("SELECT * FROM vaccinations_by_place ORDER BY location, date")


def _over_cases(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: build(_cases(spark, sf))


TIME_SERIES: dict[str, Query] = {
    "covid_running_vaccinations": running_vaccinations,
    "covid_all_rows": _over_cases(timeseries.all_rows),
    "covid_subset": _over_cases(timeseries.overview),
    "covid_death_pct": _over_cases(partial(timeseries.death_percentage, place_like=PLACE)),
    "covid_case_pct": _over_cases(partial(timeseries.case_percentage, place_like=PLACE)),
    "covid_infection_rate": _over_cases(timeseries.infection_rate),
    "covid_deaths_by_location": _over_cases(timeseries.deaths_by_location),
    "covid_deaths_by_aggregate": _over_cases(timeseries.deaths_by_aggregate),
    "covid_deaths_by_continent": _over_cases(timeseries.deaths_by_continent),
    "covid_global_by_date": _over_cases(timeseries.global_by_date),
    "covid_global": _over_cases(timeseries.global_numbers),
    "covid_global_population": _over_cases(timeseries.global_population),
    "covid_cte": covid_cte,
    "covid_temp_table": covid_temp_table,
    "covid_view": covid_view,
}

# ---- dimensions -------------------------------------------------------------------------


def dimension(spark: SparkSession, sf: str, spec: TableSpec) -> DataFrame:
    """Rows of a dimension: dev and test from raw, prod from test."""
    if spec.tier == "prod":
        rows = dimension(spark, sf, SPECS["test"][spec.table])
    elif (spec.tier, spec.table) == ("test", "Products"):
        rows = with_first_event(
            dimension(spark, sf, DEV["Products"]),
            _sold(spark, sf),
            "Product_ID",
            "Transaction_DateTime",
            "Launch_Date",
        )
    else:
        rows = standins.frame(spark, sf, standins.source_sql(spec))
    return refreshed(rows, spec)


def _sold(spark: SparkSession, sf: str) -> DataFrame:
    return standins.source(spark, sf, SPECS["test"]["Sales"])


def refreshed_table(spark: SparkSession, sf: str, spec: TableSpec) -> DataFrame:
    """A dimension's table after its load, in a database of its own."""
    own = replace(spec, tier=f"check_{spec.tier}_{spec.table.lower()}")
    _own_database(spark, own.schema_name)
    if spec.tier == "prod":
        source = dimension(spark, sf, SPECS["test"][spec.table])
    elif (spec.tier, spec.table) == ("test", "Products"):
        source = dimension(spark, sf, DEV["Products"])
    else:
        source = standins.frame(spark, sf, standins.source_sql(spec))
    loads.load_dimension(spark, own, source=source, sales=_sold(spark, sf))
    return tables.table_rows(spark, own)


def launch_date(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with the first day on which one was sold, over all sales but those of one brand.

    The parts of that brand stand for products that were never sold.
    """
    lines = standins.base(spark, sf, "lineitem")
    sold = standins.base(spark, sf, "part").where(F.col("p_brand") != UNSOLD_BRAND).select(F.col("p_partkey").alias("l_partkey"))
    lines = lines.join(sold, "l_partkey", "left_semi")
    parts = standins.base(spark, sf, "part").select("p_partkey", "p_name")
    shipped = lines.select(F.col("l_partkey").alias("p_partkey"), "l_shipdate")
    return with_first_event(parts, shipped, "p_partkey", "l_shipdate", "launch_date")


def refresh_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Refresh every dev dimension into a table of its own; rows each table then has.

    The count each refresh reports must be the same.
    """
    _own_database(spark, "check_refresh_data")
    found = []
    for name, spec in DEV.items():
        if not spec.is_fact:
            own = replace(spec, tier="check_refresh")
            seen = tables.replace_rows(dimension(spark, sf, spec), own)
            held = tables.table_rows(spark, own).agg(F.count(F.lit(1)).alias("rows_inserted"))
            same = F.assert_true(F.col("rows_inserted") == seen.get["n"])
            found.append(held.where(same.isNull()).select(F.lit(name).alias("table_name"), "rows_inserted"))
    return reduce(DataFrame.unionByName, found)


def _snake(table: str) -> str:
    return "business_lines" if table == "BusinessLines" else table.lower()


DIMENSIONS: dict[str, Query] = {
    (f"full_refresh_{_snake(name)}" if tier == "dev" else f"refresh_{tier}_{_snake(name)}"): partial(
        refreshed_table, spec=spec
    )
    for tier in TIERS
    for name, spec in SPECS[tier].items()
    if not spec.is_fact and (tier, name) != ("prod", "Products")
} | {
    "promote_products": partial(refreshed_table, spec=SPECS["prod"]["Products"]),
    "product_launch_date": launch_date,
    "full_refresh_counts": refresh_counts,
}

# ---- facts ------------------------------------------------------------------------------


def fact(spark: SparkSession, sf: str, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Target before the run and the increment in the target's shape."""
    target = standins.target(spark, sf, spec)
    since = upsert.watermark_literal(target, spec.event)
    found = upsert.increment(standins.source(spark, sf, spec), spec.source_event, since)
    rows = upsert.shaped_for(spec, found, moment(AS_OF))
    # As the loads do: the source is read once, and Spark plans with the increment's size.
    return target, tables.staged(rows, spec.table)


def _own_table(spark: SparkSession, sf: str, spec: TableSpec, rows: str, purpose: str = "") -> TableSpec:
    """The spec of a table filled with the stand-in target, in a database of its own.

    ``rows`` lie by month (``standins.fact_rows``), so that they are not dealt out again.
    """
    own = replace(spec, tier=f"check_{spec.tier}_{spec.table.lower()}{purpose}")
    _own_database(spark, own.schema_name)
    tables.create_if_missing(spark, own)
    tables.append_months(tables.with_month(standins.target(spark, sf, spec, rows), own), own)
    return own


def loaded(spark: SparkSession, sf: str, spec: TableSpec) -> DataFrame:
    """A fact table after its load."""
    rows = standins.fact_rows(spark, sf, spec)
    own = _own_table(spark, sf, spec, rows)
    loads.load_fact(spark, own, as_of=AS_OF, source=standins.source(spark, sf, spec, rows))
    return tables.table_rows(spark, own)


def load_twice(spark: SparkSession, sf: str) -> DataFrame:
    """What each of two loads of the same source counts; the second finds nothing to do."""
    rows = standins.fact_rows(spark, sf, DEV["Hr"])
    own = _own_table(spark, sf, DEV["Hr"], rows)
    source = standins.source(spark, sf, DEV["Hr"], rows)
    found = [
        (run, *loads.load_fact(spark, own, as_of=AS_OF, source=source)) for run in (1, 2)
    ]
    return spark.createDataFrame(found, "run int, rows_inserted bigint, rows_updated bigint")


def loaded_copies(spark: SparkSession, sf: str) -> DataFrame:
    """A fact table after the load of a source that holds some new rows twice: they come in twice."""
    rows = standins.fact_rows(spark, sf, DEV["Hr"])
    own = _own_table(spark, sf, DEV["Hr"], rows, "_copies")
    source = standins.source(spark, sf, DEV["Hr"], rows)
    loads.load_fact(spark, own, as_of=AS_OF, source=source.union(source.where("HR_ID % 5 = 0")))
    return tables.table_rows(spark, own)


def refused_load(spark: SparkSession, sf: str) -> DataFrame:
    """A load of old rows too that would change some more than once: what it says, and that nothing changed."""
    spec = DEV["Purchases"]
    own = _own_table(spark, sf, spec, standins.fact_rows(spark, sf, spec), "_copies")
    copies = standins.frame(spark, sf, standins.source_sql(spec, standins.LINE_COPIES))
    try:
        loads.load_fact(spark, own, as_of=AS_OF, source=copies, lookback_days=100 * 366)
        refused = None
    except loads.AmbiguousUpsert as error:
        refused = int(re.search(r"(\d+) keys", str(error))[1])
    held = tables.table_rows(spark, own)
    return held.agg(
        F.lit(refused).cast("bigint").alias("n_keys"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("Total_Amount").alias("total_amount"),
    )


def corrected(spark: SparkSession, sf: str) -> DataFrame:
    """A fact table after a load that takes corrections of any age."""
    rows = standins.fact_rows(spark, sf, SALES)
    own = _own_table(spark, sf, SALES, rows, "_corrected")
    loads.load_fact(spark, own, as_of=AS_OF, source=standins.source(spark, sf, SALES, rows), corrections=True)
    return tables.table_rows(spark, own)


SALES = DEV["Sales"]
# The count of changed rows leaves the event out, unlike the merge; kept as a report.
NOT_COUNTED = ("Transaction_DateTime",)


def watermark(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.watermark(standins.target(spark, sf, SALES), SALES.event)


def increment(spark: SparkSession, sf: str) -> DataFrame:
    return fact(spark, sf, SALES)[1]


def new_rows(spark: SparkSession, sf: str) -> DataFrame:
    target, rows = fact(spark, sf, SALES)
    return upsert.new_rows(rows, target, SALES.key)


def changed_rows(spark: SparkSession, sf: str) -> DataFrame:
    target, rows = fact(spark, sf, SALES)
    return upsert.changed_pairs(target, rows, SALES, skip=NOT_COUNTED)


def counts(spark: SparkSession, sf: str) -> DataFrame:
    target, rows = fact(spark, sf, SALES)
    return upsert.upsert_counts(target, rows, SALES)


def late(spark: SparkSession, sf: str) -> DataFrame:
    target = standins.target(spark, sf, SALES)
    since = upsert.watermark_literal(target, SALES.event)
    source = conform_schema(spark, sf)
    return upsert.late_rows(source, target, SALES.key, SALES.event, since).select(
        SALES.key, SALES.event, "Total_Amount"
    )


LATE_COLUMNS = (SALES.key, *SALES.compare, *SALES.compare_null_safe)


def late_corrections(spark: SparkSession, sf: str) -> DataFrame:
    """Sales older than the watermark that differ from what the target has, with both values."""
    target = standins.target(spark, sf, SALES)
    since = upsert.watermark_literal(target, SALES.event)
    ranges = partial(tables.staged, name="ranges")
    found = upsert.late_corrections(conform_schema(spark, sf), target, SALES, since, ranges)
    return found.select(*LATE_COLUMNS, *[c for c in found.columns if c.startswith("old_")])


def duplicate_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of which the copies of a line would change one purchase more than once."""
    spec = DEV["Purchases"]
    copies = standins.frame(spark, sf, standins.source_sql(spec, standins.LINE_COPIES))
    target = standins.target(spark, sf, spec)
    return upsert.ambiguous_keys(target, conform(copies, spec.columns), spec)


def days_outstanding(spark: SparkSession, sf: str) -> DataFrame:
    sales = standins.source(spark, sf, SALES)
    return sales.select(
        "Sales_ID",
        days_between(F.col("Transaction_DateTime"), moment(AS_OF)).alias("Days_Outstanding"),
    )


def approval_date(spark: SparkSession, sf: str) -> DataFrame:
    purchases = standins.source(spark, sf, DEV["Purchases"])
    return purchases.select(
        "Purchase_ID", plus_days(F.col("Transaction_Date"), 2).alias("Approval_Date")
    )


def conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    return conform(standins.source(spark, sf, SALES), SALES.columns)


# Loads known by what is particular to them rather than by tier and table.
FACT_NAMES = {
    ("dev", "Budget"): "upsert_budget_nullsafe",
    ("dev", "Hr"): "upsert_hr_partial",
    ("dev", "Inventory"): "upsert_inventory",
    ("dev", "Purchases"): "upsert_purchases",
    ("dev", "Sales"): "upsert_sales",
    ("test", "Sales"): "upsert_test_derived",
    ("prod", "Sales"): "upsert_prod_names",
}

FACTS: dict[str, Query] = {
    FACT_NAMES.get((tier, name), f"upsert_{tier}_{name.lower()}"): partial(loaded, spec=spec)
    for tier in TIERS
    for name, spec in SPECS[tier].items()
    if spec.is_fact
} | {
    "load_twice": load_twice,
    "load_copies": loaded_copies,
    "load_refused": refused_load,
    "load_corrections": corrected,
    "watermark": watermark,
    "increment": increment,
    "late_rows": late,
    "late_corrections": late_corrections,
    "upsert_new_rows": new_rows,
    "upsert_changed_rows": changed_rows,
    "upsert_counts": counts,
    "upsert_duplicate_guard": duplicate_guard,
    "conform_schema": conform_schema,
    "days_outstanding": days_outstanding,
    "approval_date": approval_date,
}

# ---- sample queries ---------------------------------------------------------------------


def sales_by_date(spark: SparkSession, sf: str) -> DataFrame:
    return samples.sales_by_date(conform_schema(spark, sf))


def inventory_movements(spark: SparkSession, sf: str) -> DataFrame:
    spec = DEV["Inventory"]
    return samples.inventory_movements(conform(standins.source(spark, sf, spec), spec.columns))


def active_products(spark: SparkSession, sf: str) -> DataFrame:
    return samples.active_products(dimension(spark, sf, DEV["Products"]))


def active_employees(spark: SparkSession, sf: str) -> DataFrame:
    return samples.active(dimension(spark, sf, DEV["Employees"]))


# ---- run log ----------------------------------------------------------------------------


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return standins.frame(spark, sf, standins.EXECUTION_LOGS)


def log_append(spark: SparkSession, sf: str) -> DataFrame:
    """The log with one more run: an outcome per tier and procedure, from all its runs."""
    log = _log(spark, sf)
    run = log.groupBy("SchemaName", "ProcedureName").agg(
        (F.max("StartTime") + F.expr("INTERVAL 1 DAY 700 MILLISECONDS")).alias("StartTime"),
        (F.max("EndTime") + F.expr("INTERVAL 1 DAY 400 MILLISECONDS")).alias("EndTime"),
        F.sum("RowsInserted").alias("RowsInserted"),
        F.sum("RowsUpdated").alias("RowsUpdated"),
        F.max("Status").alias("Status"),
        F.repeat(F.max("ErrorMessage"), F.lit(1000)).alias("ErrorMessage"),
    )
    return runlog.appended(log, run)


def log_retention(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.retained(_log(spark, sf), moment(RETENTION_AS_OF))


def log_error_digest(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.error_digest(_log(spark, sf), moment(DIGEST_AS_OF))


def log_error_report(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.error_report(_log(spark, sf), moment(DIGEST_AS_OF))


def _error_lists(spark: SparkSession, sf: str) -> DataFrame:
    return standins.frame(spark, sf, standins.error_lists_sql())


def error_list_rows(spark: SparkSession, sf: str) -> DataFrame:
    return errors.error_rows(_error_lists(spark, sf), "error_list", "list_id")


def error_list_report(spark: SparkSession, sf: str) -> DataFrame:
    lists = _error_lists(spark, sf)
    return errors.error_reports(lists, "error_list", moment(DIGEST_AS_OF), "list_id")


def outcome_log(spark: SparkSession, sf: str) -> DataFrame:
    """The log of a run of three loads, of which the first fails; the others go on.

    Keys of every tenth customer are missing in the raw table, which a dimension does not take.
    """
    raw, log = "check_outcomes_raw", "check_outcomes_log.Runs"
    for name in (raw, "check_outcomes_log", "check_outcomes_data"):
        _own_database(spark, name)
    ran = [replace(DEV[t], tier="check_outcomes") for t in ("Customers", "Suppliers", "Accounts")]
    for spec in ran:
        rows = standins.frame(spark, sf, standins.source_sql(spec))
        if spec.table == "Customers":
            missing = F.col("Customer_ID").endswith("0")
            rows = rows.withColumn("Customer_ID", F.when(~missing, F.col("Customer_ID")))
        tables.overwrite(rows, f"{raw}.{spec.source}")
    loads.run_loads(spark, ran, raw, log=log)
    return loads.log_rows(spark, log).select(
        "SchemaName",
        "ProcedureName",
        "RowsInserted",
        "RowsUpdated",
        "Status",
        F.regexp_extract("ErrorMessage", "Customer_ID: NULL in a NOT NULL column", 0).alias("cause"),
        (F.col("EndTime") >= F.col("StartTime")).alias("in_order"),
    )


RUN_LOG: dict[str, Query] = {
    "log_outcomes": outcome_log,
    "log_append": log_append,
    "log_retention": log_retention,
    "log_error_digest": log_error_digest,
    "log_error_report": log_error_report,
    "error_list_rows": error_list_rows,
    "error_list_report": error_list_report,
}

# ---- sources ----------------------------------------------------------------------------


def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    return tables.profiles({t: standins.base(spark, sf, t) for t in standins.BASE_TABLES})


# Headers as a sheet may have them, on the customer table.
RAW_HEADERS = ["Cust-Key", "Full Name (legal)", "Nation/Key", "Acct. Balance", "Mkt-Segment (code)"]
SHEET = "DIM Customers-2024"


def normalized_headers(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_headers(standins.base(spark, sf, "customer").toDF(*RAW_HEADERS))


def infer_types(spark: SparkSession, sf: str) -> DataFrame:
    """Types told from text: the orders as text columns."""
    orders = standins.base(spark, sf, "orders")
    return inferred_types(orders.select(*[quoted(c).cast("string").alias(c) for c in orders.columns]))


def overwrite_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Overwrite a table with rows of another schema and read it back."""
    _own_database(spark, "check_overwrite")
    name = "check_overwrite.customers"
    tables.overwrite(standins.base(spark, sf, "supplier").select("s_suppkey"), name)
    tables.overwrite(normalized_headers(spark, sf), name)
    return spark.table(name)


def _sheet_rows(spark: SparkSession, sf: str) -> DataFrame:
    files = table_workbooks(standins.base(spark, sf, "customer"), SHEET, RAW_HEADERS)
    return workbook.sheet_rows(files)


def workbook_sheets(spark: SparkSession, sf: str) -> DataFrame:
    files = table_workbooks(standins.base(spark, sf, "customer"), SHEET, RAW_HEADERS)
    return workbook.sheets(files).select("position", "sheet", "error").distinct()


def workbook_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells by sheet and column: how many, lowest and highest."""
    return (
        workbook.cells(_sheet_rows(spark, sf))
        .groupBy("sheet", "column_no")
        .agg(
            F.count(F.lit(1)).alias("n_cells"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
        )
    )


def workbook_table(spark: SparkSession, sf: str) -> DataFrame:
    """All workbooks read back as one typed table; decoded once, as the ingestion does."""
    rows = tables.staged(_sheet_rows(spark, sf), "sheets", "sheet")
    return workbook.sheet_table(rows, SHEET)


def ingest_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return (
        workbook.manifest(_sheet_rows(spark, sf))
        .groupBy("sheet", "column_count", F.array_join("columns", ", ").alias("columns"))
        .agg(F.sum("row_count").alias("row_count"))
        .withColumn("table_name", table_name_column(F.col("sheet")))
    )


def ingest_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """What an ingestion reports of workbooks with good, empty and broken sheets.

    How many workbooks there are, and their names, depend on how the table is cut; that is left out.
    """
    raw = "check_ingest_raw"
    _own_database(spark, raw)
    files = table_workbooks(standins.base(spark, sf, "customer"), SHEET, RAW_HEADERS, faults=True)
    found = loads.ingest_workbooks(spark, raw=raw, files=tables.staged(files, "files"))
    rows = {
        (re.sub(r"^\S*\.xlsx ", "", o.ProcedureName), o.RowsInserted, o.RowsUpdated, o.Status) for o in found
    }
    return spark.createDataFrame(sorted(rows), "name string, rows_inserted bigint, rows_updated bigint, status string")


def create_only(spark: SparkSession, sf: str) -> DataFrame:
    """A table that is there already is not created again; its rows stay."""
    _own_database(spark, "check_create")
    name = "check_create.suppliers"
    tables.create_only(standins.base(spark, sf, "supplier").select("s_suppkey", "s_name"), name)
    try:
        tables.create_only(standins.base(spark, sf, "customer"), name)
        refused = False
    except AnalysisException:
        refused = True
    return spark.table(name).withColumn("refused", F.lit(refused))


def limits(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the preview and the sample of each table, and how many of them the table does not have."""
    found = []
    for table in ("region", "supplier", "orders", "labels"):
        df = standins.base(spark, sf, table)
        key = df.columns[0]
        for kind, few in (("preview", tables.preview(df)), ("sample", samples.sample(df))):
            known = df.select(F.col(key).alias("key")).distinct()
            strange = few.join(known, few[key] == known["key"], "left_anti").agg(F.count(F.lit(1)).alias("n_strange"))
            counts = few.agg(F.count(F.lit(1)).alias("n_rows"))
            found.append(
                counts.withColumn("n_strange", F.lit(strange.first()[0]))
                .select(F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), "n_rows", "n_strange")
            )
    return reduce(DataFrame.unionByName, found)


SOURCES: dict[str, Query] = {
    "ingest_outcomes": ingest_outcomes,
    "create_only": create_only,
    "row_limits": limits,
    "table_profile": table_profile,
    "normalize_headers": normalized_headers,
    "infer_types": infer_types,
    "overwrite_roundtrip": overwrite_roundtrip,
    "workbook_sheets": workbook_sheets,
    "workbook_cells": workbook_cells,
    "workbook_table": workbook_table,
    "ingest_manifest": ingest_manifest,
    "sales_by_date_top10": sales_by_date,
    "inventory_movements": inventory_movements,
    "active_products": active_products,
    "active_employees": active_employees,
}

def _tuned(query: Query) -> Query:
    return lambda spark, sf: query(tuned(spark), sf)


QUERIES: dict[str, Query] = {
    name: _tuned(query)
    for name, query in (TIME_SERIES | DIMENSIONS | FACTS | RUN_LOG | SOURCES).items()
}
