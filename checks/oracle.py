"""SQL for DuckDB with the results the registered queries must give.

Written in another form than the Spark code wherever there is a choice: days joined to earlier
days instead of windows, one full join instead of two joins, pairs instead of states.
"""

from __future__ import annotations

from checks import queries as q
from checks import standins
from tidemark.functions import errors
from tidemark.functions.names import clean_header
from tidemark.operators import runlog
from tidemark.plans.specs import DEV, SPECS, TIERS, Column, TableSpec

CASES = standins.duckdb_sql(standins.COVID_DEATHS)
DOSES = standins.duckdb_sql(standins.COVID_VACCINATIONS)
LOGS = standins.duckdb_sql(standins.EXECUTION_LOGS)
LISTS = standins.duckdb_sql(standins.error_lists_sql())

# ---- time series ------------------------------------------------------------------------

DEATHS = "SUM(CAST(new_deaths AS INT))"
# Running totals without a window: each day of a place meets its earlier days.
JOINED = f"""
WITH met AS (
       SELECT continent, location, date, population, new_vaccinations
       FROM ({CASES}) AS sick JOIN ({DOSES}) AS dosed USING (location, date)
       WHERE continent IS NOT NULL),
     given AS (
       SELECT location AS place, date AS day, SUM(CAST(new_vaccinations AS BIGINT)) AS doses
       FROM met GROUP BY location, date),
     so_far AS (
       SELECT late.place, late.day, SUM(early.doses) AS doses
       FROM given AS late JOIN given AS early ON late.place = early.place AND late.day >= early.day
       GROUP BY late.place, late.day)
SELECT continent, location, date, population, new_vaccinations,
       CAST(doses AS BIGINT) AS SumOfPeopleVaccination
FROM met JOIN so_far ON location = place AND date = day
"""


def _cases(select: str, where: str = "continent IS NOT NULL", group: str = "") -> str:
    grouped = f" GROUP BY {group}" if group else ""
    return f"SELECT {select} FROM ({CASES}) AS cases WHERE {where}{grouped}"


def _deaths_by(column: str, where: str = "continent IS NOT NULL") -> str:
    return _cases(f"{column}, MAX(CAST(total_deaths AS INT)) AS TotalDeathCount", where, column)


def _report(population: str, doses: str, total: str, day: str = "date") -> str:
    return f"""
SELECT continent AS Continet, location AS Location, {day} AS Date, {population} AS Population,
       {doses} AS New_Vaccinations, {total} AS SumOfPeopleVaccination,
       CAST({total} AS DOUBLE) / NULLIF(CAST({population} AS DOUBLE), 0) * 100
         AS PercentOfVaccinations
FROM ({JOINED}) AS joined
"""


OF_PLACE = f"continent IS NOT NULL AND location LIKE '{q.PLACE}'"
TIME_SERIES = {
    "covid_running_vaccinations": JOINED,
    "covid_view": JOINED,
    "covid_cte": _report("population", "new_vaccinations", "SumOfPeopleVaccination"),
    "covid_temp_table": _report(
        "CAST(population AS DECIMAL(18,0))",
        "CAST(new_vaccinations AS DECIMAL(18,0))",
        "CAST(SumOfPeopleVaccination AS DECIMAL(18,0))",
        "CAST(date AS TIMESTAMP)",
    ),
    "covid_all_rows": _cases("*"),
    "covid_subset": _cases("location, date, total_cases, new_cases, total_deaths, population"),
    "covid_death_pct": _cases(
        "location, date, total_cases, total_deaths, "
        "CAST(total_deaths AS DOUBLE) / NULLIF(total_cases, 0) * 100 AS DeathPercentage",
        OF_PLACE,
    ),
    "covid_case_pct": _cases(
        "location, date, total_cases, population, "
        "total_cases / NULLIF(population, 0) * 100 AS CasesPercentage",
        OF_PLACE,
    ),
    "covid_infection_rate": _cases(
        "location, population, MAX(total_cases) AS HighestInfectionCount, "
        "MAX(total_cases / NULLIF(population, 0)) * 100 AS PercentPopulationInfected",
        group="location, population",
    ),
    "covid_deaths_by_location": _deaths_by("location"),
    "covid_deaths_by_aggregate": _deaths_by("location", "continent IS NULL"),
    "covid_deaths_by_continent": _deaths_by("continent"),
    "covid_global_by_date": _cases(
        f"date, SUM(new_cases) AS total_cases, CAST({DEATHS} AS BIGINT) AS total_deaths, "
        f"CAST({DEATHS} AS DOUBLE) / NULLIF(SUM(new_cases), 0) * 100 AS DeathPercentage",
        group="date",
    ),
    "covid_global": _cases(
        f"SUM(new_cases) AS total_cases, CAST({DEATHS} AS BIGINT) AS total_deaths, "
        f"CAST({DEATHS} AS DOUBLE) / NULLIF(SUM(new_cases), 0) * 100 AS DeathPercentage"
    ),
    "covid_global_population": _cases(
        "SUM(population) AS GlobalPopulation, SUM(new_cases) AS total_new_cases, "
        f"CAST({DEATHS} AS BIGINT) AS total_new_deaths, "
        "SUM(new_cases) / NULLIF(SUM(population), 0) * 100 AS GlobalInfectedPopulation, "
        f"CAST({DEATHS} AS DOUBLE) / NULLIF(SUM(population), 0) * 100 AS GlobalDeathPopulation, "
        f"CAST({DEATHS} AS DOUBLE) / NULLIF(SUM(new_cases), 0) * 100 AS InfestationDeathPercentage"
    ),
}

# ---- dimensions and facts ---------------------------------------------------------------

TODAY = f"DATE '{q.AS_OF.date()}'"


def _type(column: Column) -> str:
    if column.max_length is not None:
        return "VARCHAR"
    return "TIMESTAMP" if column.type == "TIMESTAMP_NTZ" else column.type


def _name(name: str) -> str:
    return f'"{name}"'


def _derived(spec: TableSpec) -> dict[str, str]:
    if spec.tier != "test":
        return {}
    age = f"DATE_DIFF('day', CAST(Transaction_DateTime AS DATE), {TODAY})"
    return {
        "Sales": {"Days_Outstanding": age, "Delivery_Days": age},
        "Purchases": {"Approval_Date": "Transaction_Date + INTERVAL 2 DAY"},
    }.get(spec.table, {})


def _source(spec: TableSpec) -> str:
    """The source under the target's names and types."""
    raw = {new: old for old, new in spec.renames.items()}
    derived = _derived(spec)
    listed = ", ".join(
        f"CAST({derived.get(c.name) or raw.get(c.name, c.name)} AS {_type(c)}) AS {_name(c.name)}"
        for c in spec.columns
    )
    return f"SELECT {listed} FROM ({standins.duckdb_sql(standins.source_sql(spec))}) AS raw"


def _target(spec: TableSpec) -> str:
    listed = ", ".join(
        f"CAST({_name(c.name)} AS {_type(c)}) AS {_name(c.name)}" for c in spec.columns
    )
    return f"SELECT {listed} FROM ({standins.duckdb_sql(standins.target_sql(spec))}) AS raw"


def _dimension(spec: TableSpec) -> str:
    if spec.table == "Products" and spec.tier != "dev":
        raw = {new: old for old, new in spec.renames.items()}
        listed = ", ".join(
            f"CAST({raw.get(c.name, c.name)} AS {_type(c)}) AS {_name(c.name)}" for c in spec.columns
        )
        return f"""
WITH sold AS ({_source(SPECS["test"]["Sales"])}),
     parts AS ({standins.duckdb_sql(standins.source_sql(spec))}),
     launched AS (
       SELECT parts.*, (SELECT MIN(Transaction_DateTime) FROM sold
                        WHERE sold.Product_ID = parts.Product_ID) AS Launch_Date
       FROM parts)
SELECT {listed} FROM launched
"""
    return _source(spec)


def _changed(spec: TableSpec, skip: tuple[str, ...] = ()) -> str:
    terms = [f"t.{_name(c)} <> s.{_name(c)}" for c in spec.compare if c not in skip]
    terms += [
        f"COALESCE(t.{_name(c)}, '') <> COALESCE(s.{_name(c)}, '')"
        for c in spec.compare_null_safe
    ]
    return f"COALESCE({' OR '.join(terms)}, FALSE)"


def _run(spec: TableSpec) -> str:
    event = _name(spec.event)
    return f"""
WITH tgt AS ({_target(spec)}),
     src AS ({_source(spec)}),
     mark AS (SELECT COALESCE(MAX({event}), TIMESTAMP '1900-01-01') AS w FROM tgt),
     inc AS (SELECT src.* FROM src JOIN mark ON src.{event} >= mark.w)
"""


def _merge(spec: TableSpec, since: bool = True) -> str:
    """The table after its load; without ``since`` old source rows change it too, but add nothing."""
    key = _name(spec.key)
    taken = f"t.{key} IS NULL OR (s.{key} IS NOT NULL AND {_changed(spec)})"
    listed = ", ".join(
        f"CASE WHEN {f't.{key} IS NULL' if c in spec.never_updated else taken} "
        f"THEN s.{_name(c)} ELSE t.{_name(c)} END AS {_name(c)}"
        for c in spec.names
    )
    taking = "inc" if since else f"(SELECT * FROM inc UNION ALL SELECT src.* FROM src JOIN mark ON src.{_name(spec.event)} < w WHERE src.{key} IN (SELECT {key} FROM tgt))"
    return f"{_run(spec)} SELECT {listed} FROM tgt AS t FULL JOIN {taking} AS s ON t.{key} = s.{key}"


def _copies(spec: TableSpec) -> str:
    """How often the copies of lines would change each target row."""
    key = spec.key
    listed = ", ".join(f"CAST({c.name} AS {_type(c)}) AS {c.name}" for c in spec.columns)
    return f"""
WITH tgt AS ({_target(spec)}),
     raw AS ({standins.duckdb_sql(standins.source_sql(spec, standins.LINE_COPIES))}),
     copies AS (SELECT {listed} FROM raw),
     numbered AS (SELECT ROW_NUMBER() OVER () AS row_id, tgt.* FROM tgt),
     per_row AS (
       SELECT t.row_id, t.{key}, COUNT(*) AS n
       FROM numbered AS t JOIN copies AS s ON t.{key} = s.{key}
       WHERE {_changed(spec)} AND s.{key} IN (SELECT {key} FROM copies GROUP BY 1 HAVING COUNT(*) > 1)
       GROUP BY t.row_id, t.{key})
"""


DIMENSIONS = {
    name: _dimension(query.keywords["spec"])
    for name, query in q.DIMENSIONS.items()
    if hasattr(query, "keywords")
} | {
    "product_launch_date": f"""
SELECT p_partkey, p_name,
       MIN(CASE WHEN p_brand <> '{q.UNSOLD_BRAND}' THEN l_shipdate END) AS launch_date
FROM part LEFT JOIN lineitem ON p_partkey = l_partkey
GROUP BY p_partkey, p_name
""",
    "full_refresh_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS rows_inserted FROM ({_dimension(spec)}) AS d"
        for name, spec in DEV.items()
        if not spec.is_fact
    ),
}

SALES = q.SALES
PURCHASES = DEV["Purchases"]
COMPARED = (*SALES.compare, *SALES.compare_null_safe)

FACTS = {
    name: _merge(query.keywords["spec"])
    for name, query in q.FACTS.items()
    if hasattr(query, "keywords")
} | {
    "load_twice": f"""{_run(DEV["Hr"])}
SELECT CAST(1 AS INT) AS run,
       (SELECT COUNT(*) FROM inc WHERE HR_ID NOT IN (SELECT HR_ID FROM tgt)) AS rows_inserted,
       (SELECT COUNT(*) FROM tgt AS t JOIN inc AS s ON t.HR_ID = s.HR_ID
        WHERE {_changed(DEV["Hr"])}) AS rows_updated
UNION ALL SELECT 2, 0, 0
""",
    "load_copies": f"""
WITH merged AS ({_merge(DEV["Hr"])}), before AS ({_target(DEV["Hr"])})
SELECT * FROM merged
UNION ALL
SELECT * FROM merged WHERE HR_ID % 5 = 0 AND HR_ID NOT IN (SELECT HR_ID FROM before)
""",
    "load_refused": f"""{_copies(PURCHASES)}
SELECT (SELECT COUNT(DISTINCT Purchase_ID) FROM per_row WHERE n > 1) AS n_keys, COUNT(*) AS n_rows,
       SUM(Total_Amount) AS total_amount
FROM tgt
""",
    "load_corrections": _merge(SALES, since=False),
    "watermark": f"{_run(SALES)} SELECT w AS watermark FROM mark",
    "increment": f"{_run(SALES)} SELECT * FROM inc",
    "late_rows": f"""{_run(SALES)}
SELECT Sales_ID, Transaction_DateTime, Total_Amount FROM src JOIN mark ON Transaction_DateTime < w
WHERE Sales_ID NOT IN (SELECT Sales_ID FROM tgt)
""",
    "late_corrections": f"""{_run(SALES)}
SELECT {", ".join(f"s.{c}" for c in q.LATE_COLUMNS)}, {", ".join(f"t.{c} AS old_{c}" for c in COMPARED)}
FROM src AS s JOIN tgt AS t ON s.Sales_ID = t.Sales_ID, mark
WHERE s.Transaction_DateTime < w AND {_changed(SALES)}
""",
    "upsert_new_rows": f"""{_run(SALES)}
SELECT * FROM inc WHERE Sales_ID NOT IN (SELECT Sales_ID FROM tgt)
""",
    "upsert_changed_rows": f"""{_run(SALES)}
SELECT s.Sales_ID, {", ".join(f"t.{c} AS old_{c}, s.{c} AS {c}" for c in COMPARED)}
FROM tgt AS t, inc AS s
WHERE t.Sales_ID = s.Sales_ID AND {_changed(SALES, q.NOT_COUNTED)}
""",
    "upsert_counts": f"""{_run(SALES)}
SELECT 'rows_inserted' AS what, COUNT(*) AS n FROM inc
WHERE Sales_ID NOT IN (SELECT Sales_ID FROM tgt)
UNION ALL
SELECT 'rows_updated', COUNT(*) FROM tgt AS t JOIN inc AS s ON t.Sales_ID = s.Sales_ID
WHERE {_changed(SALES)}
""",
    "upsert_duplicate_guard": f"""{_copies(PURCHASES)}
SELECT Purchase_ID, MAX(n) AS n_changes FROM per_row GROUP BY Purchase_ID HAVING MAX(n) > 1
""",
    "conform_schema": _source(SALES),
    "days_outstanding": f"""
SELECT Sales_ID, CAST({TODAY} - CAST(Transaction_DateTime AS DATE) AS INT) AS Days_Outstanding
FROM ({_source(SALES)}) AS sales
""",
    "approval_date": f"""
SELECT Purchase_ID, Transaction_Date + INTERVAL 48 HOUR AS Approval_Date
FROM ({_source(PURCHASES)}) AS purchases
""",
}

# ---- run log ----------------------------------------------------------------------------

SINCE = f"TIMESTAMP '{q.DIGEST_AS_OF}' - INTERVAL {runlog.LOOKBACK_HOURS} HOUR"
DIGEST = f"""
SELECT SchemaName, STRING_AGG(ProcedureName || ': ' || ErrorMessage, chr(13) ORDER BY StartTime, LogID)
         AS errors
FROM ({LOGS}) AS logs
WHERE Status = 'Error' AND StartTime >= {SINCE}
GROUP BY SchemaName
"""

# Each field as the report shows it: absent, null or its text.
FIELD = (
    "CASE WHEN NOT json_exists(e, '$.{0}') THEN '" + errors.MISSING + "' "
    "ELSE COALESCE(e->>'$.{0}', '" + errors.NULL_TEXT + "') END"
)
LISTED = f"""
SELECT list_id, UNNEST(RANGE(1, CAST(json_array_length(error_list) AS BIGINT) + 1)) AS error_no,
       json_array_length(error_list) AS n_errors,
       UNNEST(CAST(json_extract(error_list, '$[*]') AS JSON[])) AS e
FROM (SELECT * FROM ({LISTS}) AS l WHERE json_valid(TRIM(error_list)) AND TRIM(error_list) <> '') AS lists
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


BLOCK = " || chr(10) || ".join(
    ["'  Error #' || error_no"]
    + [
        _text(f"  {label + ':':<{errors.LABEL_WIDTH}}") + f" || {FIELD.format(name)}"
        for name, label in errors.ERROR_FIELDS
    ]
    + [_text(errors.SINGLE_RULE), "chr(10)"]
)
HEADER = " || chr(10) || ".join(
    [
        _text(errors.DOUBLE_RULE),
        _text(errors.TITLE),
        _text(errors.DOUBLE_RULE),
        "''",
        _text(f"  {'Timestamp:':<{errors.LABEL_WIDTH}}{q.DIGEST_AS_OF}"),
        _text(f"  {'Total Errors:':<{errors.LABEL_WIDTH}}") + " || MAX(n_errors)",
        "''",
        _text(errors.SINGLE_RULE),
        "''",
        "''",
    ]
)
FOOTER = f"{_text(errors.CLOSING)} || chr(10) || {_text(errors.DOUBLE_RULE)} || chr(10)"

def _logged(table: str, failing: bool = False) -> str:
    name = f"check_outcomes_data' AS SchemaName, 'pr_check_outcomes_{DEV[table].source}"
    count, status, cause = ("0 * COUNT(*)", "Error", "'Customer_ID: NULL in a NOT NULL column'") if failing else ("COUNT(*)", "Success", "NULL")
    return f"""SELECT '{name}' AS ProcedureName, CAST({count} AS BIGINT) AS RowsInserted, CAST(0 AS BIGINT) AS RowsUpdated,
       '{status}' AS Status, CAST({cause} AS VARCHAR) AS cause, TRUE AS in_order FROM ({_dimension(DEV[table])}) AS d"""


RUN_LOG = {
    "log_outcomes": " UNION ALL ".join([_logged("Customers", failing=True), _logged("Suppliers"), _logged("Accounts")]),
    "log_append": f"""
WITH logs AS ({LOGS}),
     run AS (
       SELECT SchemaName, ProcedureName,
              MAX(StartTime) + INTERVAL 1 DAY + INTERVAL 1 SECOND AS StartTime,
              MAX(EndTime) + INTERVAL 1 DAY AS EndTime,
              CAST(SUM(RowsInserted) AS BIGINT) AS RowsInserted,
              CAST(SUM(RowsUpdated) AS BIGINT) AS RowsUpdated,
              MAX(Status) AS Status,
              LEFT(REPEAT(MAX(ErrorMessage), 1000), {runlog.ERROR_LENGTH}) AS ErrorMessage
       FROM logs GROUP BY SchemaName, ProcedureName)
SELECT * FROM logs
UNION ALL
SELECT (DATE_DIFF('second', TIMESTAMP '{runlog.ID_EPOCH}', StartTime) << 32) - 1
         + ROW_NUMBER() OVER (PARTITION BY StartTime ORDER BY SchemaName, ProcedureName) AS LogID, run.*
FROM run
""",
    "log_retention": f"""
SELECT * FROM ({LOGS}) AS logs
WHERE StartTime IS NULL
   OR StartTime >= TIMESTAMP '{q.RETENTION_AS_OF}' - INTERVAL {runlog.KEEP_DAYS} DAY
""",
    "log_error_digest": DIGEST,
    "log_error_report": f"""
WITH digest AS ({DIGEST})
SELECT CONCAT_WS(chr(13) || chr(13), {", ".join(
    f"'{title}:' || chr(13) || (SELECT errors FROM digest WHERE SchemaName = '{schema}')"
    for schema, title in runlog.REPORT_TIERS
)}) AS FormattedErrorList
""",
    "error_list_rows": f"""
SELECT list_id, CAST(error_no AS INT) AS error_no,
       {", ".join(f"{FIELD.format(name)} AS {name}" for name, _ in errors.ERROR_FIELDS)}
FROM ({LISTED}) AS listed
""",
    "error_list_report": f"""
WITH blocks AS (SELECT list_id, error_no, n_errors, {BLOCK} AS block FROM ({LISTED}) AS listed),
     reports AS (
       SELECT list_id, {HEADER} || STRING_AGG(block, '' ORDER BY error_no) || {FOOTER} AS report
       FROM blocks GROUP BY list_id)
SELECT lists.list_id, report FROM ({LISTS}) AS lists LEFT JOIN reports ON lists.list_id = reports.list_id
""",
}

# ---- sources ----------------------------------------------------------------------------

CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
CLEANED = ", ".join(f"{c} AS {clean_header(h)}" for c, h in zip(CUSTOMER, q.RAW_HEADERS))


def _profile(table: str) -> str:
    columns = f"FROM (DESCRIBE SELECT * FROM {table})"
    return f"""
SELECT '{table}' AS table_name, (SELECT COUNT(*) FROM {table}) AS row_count,
       (SELECT CAST(COUNT(*) AS INT) {columns}) AS column_count,
       (SELECT ARRAY_TO_STRING(LIST(column_name)[1:5], ', ') {columns}) AS first_columns
"""


def _column_cells(sheet: str, number: int, column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return (
        f"SELECT '{sheet}' AS sheet, {number} AS column_no, COUNT({column}) AS n_cells, "
        f"MIN({text}) AS lowest, MAX({text}) AS highest FROM customer"
    )


ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}

def clean_name(sheet: str) -> str:
    return sheet.replace(" ", "_").replace("-", "_").lower()


SOURCES = {
    "table_profile": " UNION ALL ".join(_profile(t) for t in standins.BASE_TABLES),
    "normalize_headers": f"SELECT {CLEANED} FROM customer",
    "overwrite_roundtrip": f"SELECT {CLEANED} FROM customer",
    "workbook_table": "SELECT "
    + ", ".join(
        f"{f'CAST({c} AS BIGINT)' if c == 'c_nationkey' else c} AS {clean_header(h)}"
        for c, h in zip(CUSTOMER, q.RAW_HEADERS)
    )
    + " FROM customer",
    "infer_types": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS n_values, '{kind}' AS inferred_type FROM orders"
        for c, kind in ORDER_TYPES.items()
    ),
    "workbook_sheets": f"""
SELECT CAST(1 AS INT) AS position, '{q.SHEET}' AS sheet, CAST(NULL AS VARCHAR) AS error
FROM customer HAVING COUNT(*) > 0
UNION ALL
SELECT 2, '{q.SHEET} keys', NULL FROM customer HAVING COUNT(*) > 0
""",
    "workbook_cells": " UNION ALL ".join(
        [_column_cells(q.SHEET, i, c) for i, c in enumerate(CUSTOMER, 1)]
        + [_column_cells(f"{q.SHEET} keys", 1, CUSTOMER[0])]
    ),
    "ingest_manifest": f"""
SELECT '{q.SHEET}' AS sheet, 5 AS column_count, '{", ".join(q.RAW_HEADERS)}' AS columns,
       COUNT(*) AS row_count, '{q.SHEET.replace(" ", "_").replace("-", "_")}' AS table_name
FROM customer
UNION ALL
SELECT '{q.SHEET} keys', 1, '{q.RAW_HEADERS[0]}', COUNT(*),
       '{q.SHEET.replace(" ", "_").replace("-", "_")}_keys'
FROM customer
""",
    "ingest_outcomes": f"""
SELECT 'check_ingest_raw.{clean_name(q.SHEET)}' AS name, COUNT(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, 'Success' AS status FROM customer
UNION ALL SELECT 'check_ingest_raw.{clean_name(q.SHEET)}_keys', COUNT(*), 0, 'Success' FROM customer
UNION ALL SELECT 'check_ingest_raw.notes', 0, 0, 'Error' FROM customer HAVING COUNT(*) > 0
UNION ALL SELECT 'Broken sheet', 0, 0, 'Error' FROM customer HAVING COUNT(*) > 0
""",
    "create_only": "SELECT s_suppkey, s_name, TRUE AS refused FROM supplier",
    "row_limits": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{kind}' AS kind, LEAST(COUNT(*), {n}) AS n_rows, CAST(0 AS BIGINT) AS n_strange FROM {table}"
        for table in ("region", "supplier", "orders", "labels")
        for kind, n in (("preview", 3), ("sample", 5))
    ),
    "sales_by_date_top10": f"""
SELECT Date_ID, COUNT(*) AS Transaction_Count, SUM(Total_Amount) AS Total_Sales,
       SUM(Profit_Amount) AS Total_Profit
FROM ({_source(SALES)}) AS sales
GROUP BY Date_ID ORDER BY Date_ID DESC LIMIT 10
""",
    "inventory_movements": f"""
SELECT Product_ID, Movement_Type, SUM(Quantity) AS Total_Quantity, COUNT(*) AS Movement_Count
FROM ({_source(DEV["Inventory"])}) AS inventory
GROUP BY Product_ID, Movement_Type
""",
    "active_products": f"""
SELECT Product_ID, Product_Name, Category, Brand, Unit_Price
FROM ({_source(DEV["Products"])}) AS products WHERE Is_Active
""",
    "active_employees": f"SELECT * FROM ({_source(DEV['Employees'])}) AS employees WHERE Is_Active",
}

ORACLE: dict[str, str] = TIME_SERIES | DIMENSIONS | FACTS | RUN_LOG | SOURCES
