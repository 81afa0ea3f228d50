"""The tables the loads and analyses read, imitated from the driver's tables.

Each stand-in is one SQL text in the dialect Spark and DuckDB share, so both sides of a
comparison start from the same rows; ``{ts}`` and ``{dow}`` stand for the few spellings
that differ. Raw columns have the types a workbook reader would infer.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.dates import month_start
from tidemark.operators.conform import quoted
from tidemark.operators.upsert import MONTH
from tidemark.plans.specs import DEV, SPECS, TEST, Column, TableSpec
from tidemark.sources import tables

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK = {"ts": "TIMESTAMP_NTZ", "dow": "WEEKDAY({0}) + 1"}
DUCKDB = {"ts": "TIMESTAMP", "dow": "ISODOW({0})"}

COVID_DEATHS = """
SELECT CASE WHEN n_nationkey % 5 = 4 THEN NULL ELSE r_name END AS continent,
       n_name AS location,
       day AS date,
       CAST(1000 * (n_nationkey + 1) AS DOUBLE) AS population,
       CAST(SUM(cases) OVER (PARTITION BY n_name ORDER BY day) AS DOUBLE) AS total_cases,
       CAST(cases AS DOUBLE) AS new_cases,
       CAST(SUM(deaths) OVER (PARTITION BY n_name ORDER BY day) AS STRING) AS total_deaths,
       CAST(deaths AS STRING) AS new_deaths
FROM (
  SELECT n_nationkey, n_name, r_name, CAST(o_orderdate AS DATE) AS day,
         COUNT(*) AS cases, SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS deaths
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  GROUP BY n_nationkey, n_name, r_name, CAST(o_orderdate AS DATE)
) AS daily
"""

COVID_VACCINATIONS = """
SELECT n_name AS location,
       CAST(l_shipdate AS DATE) AS date,
       CAST(CAST(SUM(l_quantity) AS BIGINT) AS STRING) AS new_vaccinations
FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
GROUP BY n_name, CAST(l_shipdate AS DATE)
"""

EXECUTION_LOGS = """
SELECT event_id AS LogID,
       CASE user_id % 3 WHEN 0 THEN 'dev_data' WHEN 1 THEN 'test_data' ELSE 'prod_data' END
         AS SchemaName,
       'pr_' || event_type AS ProcedureName,
       CAST(SUBSTR(CAST(ts AS STRING), 1, 19) AS {ts}) AS StartTime,
       CAST(SUBSTR(CAST(ts AS STRING), 1, 19) AS {ts}) + INTERVAL 2 SECOND AS EndTime,
       user_id AS RowsInserted,
       user_id % 7 AS RowsUpdated,
       CASE WHEN event_type = 'error' THEN 'Error' ELSE 'Success' END AS Status,
       CASE WHEN event_type = 'error' AND event_id % 17 <> 0 THEN props END AS ErrorMessage
FROM events
"""

# One JSON text per log row: two errors, the second without a message and with an explicit
# null, also after other white space; the texts a pipeline may send when it has nothing to say;
# and two that are no JSON, for what follows the list and for their quotes.
ERROR_LISTS = """
SELECT LogID AS list_id,
       CASE LogID % 7
         WHEN 0 THEN ''
         WHEN 1 THEN ' [] '
         WHEN 2 THEN 'DEV: ' || ProcedureName
         WHEN 3 THEN '[{{"SchemaName": "s"}}] xyz'
         WHEN 4 THEN REPLACE('[{{"SchemaName": "s"}}]', '"', CHR(39))
         ELSE CASE WHEN LogID % 2 = 0 THEN CHR(10) || CHR(9) ELSE ' ' END || '[{{"SchemaName": "' || SchemaName || '", "ProcedureName": "' || ProcedureName
           || '", "Status": "' || Status || '", "ErrorMessage": "code ' || CAST(RowsInserted AS STRING)
           || '", "StartTime": "' || SUBSTR(CAST(StartTime AS STRING), 1, 19)
           || '", "EndTime": "' || SUBSTR(CAST(EndTime AS STRING), 1, 19)
           || '"}}, {{"SchemaName": "' || SchemaName || '", "Status": null}}]'
       END AS error_list
FROM ({logs}) AS logs
"""

DIMENSIONS = {
    "Accounts": """
SELECT DISTINCT 'ACC-' || c_mktsegment AS Account_ID,
       c_mktsegment AS Account_Name,
       'Revenue' AS Account_Type,
       'Income Statement' AS Financial_Statement
FROM customer
""",
    "BusinessLines": """
SELECT DISTINCT p_type || '/' || p_brand AS Business_Line_ID,
       p_type || ' ' || p_brand AS Business_Line_Name,
       p_brand AS Region,
       'Active' AS Status
FROM part
""",
    "Customers": """
SELECT 'C' || CAST(c_custkey AS STRING) AS Customer_ID,
       c_name AS Customer_Name,
       c_mktsegment AS Customer_Type,
       CASE WHEN c_acctbal < 0 THEN 'Debtor' ELSE 'Regular' END AS Customer_Segment,
       n_name AS City,
       r_name AS Country,
       CAST(CAST('2000-01-01' AS DATE) + INTERVAL 7 DAY AS DATE) AS Registration_Date,
       c_acctbal AS Credit_Limit,
       c_custkey % 2 AS Is_Active
FROM customer
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
""",
    "Products": """
SELECT CAST(p_partkey AS STRING) AS Product_ID,
       p_name AS Product_Name,
       'SKU ' || CAST(p_partkey AS STRING) AS SKU,
       p_type AS Category,
       p_brand AS Brand,
       p_retailprice AS Unit_Cost,
       p_retailprice + 10 AS Unit_Price,
       CAST(p_size AS DOUBLE) / 4 AS Weight_KG,
       p_partkey % 2 AS Is_Active,
       CAST(p_size % 30 AS DOUBLE) AS Markup_Pct
FROM part
""",
    "Employees": """
SELECT 'E' || CAST(c_custkey AS STRING) AS Employee_ID,
       c_name AS Employee_Name,
       c_mktsegment AS Department,
       CASE WHEN c_custkey % 10 = 0 THEN 'Manager' ELSE 'Clerk' END AS Position,
       n_name AS Location,
       CAST(CAST('2010-03-01' AS DATE) + INTERVAL 30 DAY AS DATE) AS Hire_Date,
       c_acctbal AS Salary,
       c_custkey % 2 AS Is_Active
FROM customer
JOIN nation ON c_nationkey = n_nationkey
""",
    "Suppliers": """
SELECT CAST(s_suppkey AS STRING) AS Supplier_ID,
       s_name AS Supplier_Name,
       'Trade' AS Supplier_Type,
       n_name AS Country,
       'NET 30' AS Payment_Terms,
       s_suppkey % 5 + 1 AS Quality_Rating,
       s_suppkey % 2 AS Is_Active
FROM supplier
JOIN nation ON s_nationkey = n_nationkey
""",
    "Documents": """
SELECT 'D' || CAST(o_orderkey AS STRING) AS Document_ID,
       'INV-' || CAST(o_orderkey AS STRING) AS Document_Number,
       o_orderpriority AS Document_Type,
       CAST(o_orderdate AS DATE) AS Document_Date,
       o_orderstatus AS Status
FROM orders
""",
    "Date": """
SELECT YEAR(d) * 10000 + MONTH(d) * 100 + DAY(d) AS Date_ID,
       d AS Date,
       YEAR(d) AS Year,
       QUARTER(d) AS Quarter,
       MONTH(d) AS Month,
       SUBSTR(MONTHNAME(d), 1, 3) AS Month_Name,
       WEEKOFYEAR(d) AS Week,
       DAY(d) AS Day,
       {day_of_week} AS Day_of_Week,
       SUBSTR(DAYNAME(d), 1, 3) AS Day_Name,
       CASE WHEN {day_of_week} > 5 THEN 1 ELSE 0 END AS Is_Weekend,
       0 AS Is_Holiday
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) AS days
""",
}

ORDER_ROWS = """
SELECT o_orderkey AS k, o_custkey AS party, o_totalprice AS amount, o_orderstatus AS status,
       CAST(o_orderdate AS DATE) AS day, 1 AS line, o_custkey AS product, 1.0 AS quantity
FROM orders
"""

# lineitem holds some (order, line) pairs more than once; a fact has one row per pair.
LINE_ROWS = """
SELECT l_orderkey * 10 + l_linenumber AS k, MIN(l_suppkey) AS party,
       MAX(l_extendedprice) AS amount,
       CHR(MIN(ASCII(l_linestatus))) AS status, CAST(MAX(l_shipdate) AS DATE) AS day,
       MIN(l_linenumber) AS line, MIN(l_partkey) AS product, SUM(l_quantity) AS quantity
FROM lineitem
GROUP BY l_orderkey, l_linenumber
"""

# The same lines, copies included.
LINE_COPIES = """
SELECT l_orderkey * 10 + l_linenumber AS k, l_suppkey AS party, l_extendedprice AS amount,
       l_linestatus AS status, CAST(l_shipdate AS DATE) AS day, l_linenumber AS line,
       l_partkey AS product, l_quantity AS quantity
FROM lineitem
"""

MONTH_OF_DAY = "MAKE_DATE(YEAR(day), MONTH(day), 1)"

FACT_ROWS = {
    "Budget": ORDER_ROWS,
    "Hr": ORDER_ROWS,
    "Inventory": LINE_ROWS,
    "Purchases": LINE_ROWS,
    "Sales": ORDER_ROWS,
}

# Columns that decide results. The event is the month's start, so that many rows share the
# date of the watermark; purchases keep their days.
FACT_COLUMNS = {
    "Budget": {
        "Budget_ID": "k",
        "Last_Modified_Date": MONTH_OF_DAY,
        "Actual_Amount": "amount",
        "Budgeted_Amount": "CAST(amount AS DECIMAL(18,2)) + 100",
        "Approval_Status": "status",
    },
    "Hr": {
        "HR_ID": "k",
        "Processing_Date": MONTH_OF_DAY,
        "Net_Amount": "amount",
        "Payment_Status": "status",
        "Hours_Worked": "party % 200",
        "Hourly_Rate": "party % 50",
    },
    "Inventory": {
        "Inventory_ID": "k",
        "Transaction_DateTime": f"CAST({MONTH_OF_DAY} AS {{ts}})",
        "Product_ID": "CAST(product AS STRING)",
        "Movement_Type": "status",
        "Quantity": "quantity",
        "Total_Value": "amount",
        "Is_Verified": "k % 2",
    },
    "Purchases": {
        "Purchase_ID": "k",
        "Purchase_Line_Number": "line",
        "Transaction_Date": "CAST(day AS {ts}) + INTERVAL 90 MINUTE",
        "Product_ID": "CAST(product AS STRING)",
        "Supplier_ID": "CAST(party AS STRING)",
        "Total_Amount": "amount",
        "Delivery_Status": "status",
        "Currency": "'RON'",
    },
    "Sales": {
        "Sales_ID": "k",
        "Sales_Line_Number": "line",
        "Transaction_DateTime": f"CAST({MONTH_OF_DAY} AS {{ts}})",
        "Product_ID": "CAST(product AS STRING)",
        "Customer_ID": "'C' || CAST(party AS STRING)",
        "Total_Amount": "amount",
        "Payment_Status": "status",
    },
}

# What a target differs in from its source: (amount to alter, status to alter).
ALTERED = {
    "Budget": ("Actual_Amount", "Approval_Status"),
    "Hr": ("Net_Amount", "Payment_Status"),
    "Inventory": ("Total_Value", "Movement_Type"),
    "Purchases": ("Total_Amount", "Delivery_Status"),
    "Sales": ("Total_Amount", "Payment_Status"),
}

# Targets end here; everything from here on is new to them.
LOADED_UNTIL = "2000-01-01"


def _filler(position: int, column: Column) -> str:
    """A raw value for a column no rule looks at: differs by row and by column."""
    spread = f"k % {17 + position}"
    if column.name == "Date_ID":
        return "YEAR(day) * 10000 + MONTH(day) * 100 + DAY(day)"
    if column.type.startswith("VARCHAR"):
        return f"'{column.name} ' || CAST({spread} AS STRING)"
    if column.type.startswith("DECIMAL"):
        return f"CAST({spread} AS DOUBLE) / 4"
    if column.type == "DATE":
        return f"CAST(day + INTERVAL {position} DAY AS DATE)"
    if column.type == "TIMESTAMP_NTZ":
        return f"CAST(day AS {{ts}}) + INTERVAL {position} HOUR"
    return spread


def _raw_name(spec: TableSpec, name: str) -> str:
    shown = {new: old for old, new in spec.renames.items()}
    return shown.get(name, name)


def source_columns(spec: TableSpec) -> tuple[Column, ...]:
    """Raw columns of a fact's source: prod reads test's columns, the others dev's."""
    return (TEST if spec.tier == "prod" else DEV)[spec.table].columns


def source_sql(spec: TableSpec, rows: str | None = None) -> str:
    """Source of a load, under its raw column names."""
    if not spec.is_fact:
        text = DIMENSIONS[spec.table].replace("{day_of_week}", "{dow}")
        return text
    known = FACT_COLUMNS[spec.table]
    listed = ",\n  ".join(
        f"{known.get(c.name) or _filler(i, c)} AS {c.name}"
        for i, c in enumerate(source_columns(spec))
    )
    return f"SELECT {listed}\nFROM ({rows or FACT_ROWS[spec.table]}) AS facts"


def target_sql(spec: TableSpec, rows: str | None = None) -> str:
    """Target of a fact load before the run, under its own column names.

    Some keys are missing, some amounts and states differ, some states are NULL; columns
    that test derives hold what an earlier run left there.
    """
    amount, status = ALTERED[spec.table]
    key, event = _raw_name(spec, spec.key), _raw_name(spec, spec.event)
    changed = {
        amount: f"CAST({amount} AS DECIMAL(18,2)) + CASE WHEN {key} % 11 = 0 THEN 1 ELSE 0 END",
        status: f"CASE WHEN {key} % 13 = 0 THEN NULL WHEN {key} % 7 = 0 THEN 'X' ELSE {status} END",
    }
    if spec.table == "Hr":
        changed["Hourly_Rate"] = f"Hourly_Rate + CASE WHEN {key} % 11 = 0 THEN 1 ELSE 0 END"
    old = {
        "Days_Outstanding": "CAST(1 AS INT)",
        "Delivery_Days": "CAST(2 AS INT)",
        "Approval_Date": f"{event} + INTERVAL 1 DAY",
    }
    if spec.tier == "test":
        changed |= {c: old[c] for c in spec.derived}
    listed = ",\n  ".join(
        f"{changed.get(raw, raw)} AS {ident(c.name)}"
        for c in spec.columns
        for raw in [_raw_name(spec, c.name)]
    )
    return (
        f"SELECT {listed}\nFROM ({source_sql(spec, rows)}) AS loaded\n"
        f"WHERE {event} <= CAST('{LOADED_UNTIL}' AS {{ts}}) AND {key} % 5 <> 0"
    )


def ident(name: str) -> str:
    """Identifier in braces, replaced per engine: backticks in Spark, quotes in DuckDB."""
    return name if name.replace("_", "").isalnum() else f"<<{name}>>"


def _spell(sql: str, dialect: dict[str, str], quote: str) -> str:
    sql = sql.replace("{dow}", dialect["dow"].format("d")).replace("{ts}", dialect["ts"])
    return sql.replace("<<", quote).replace(">>", quote).replace("{{", "{").replace("}}", "}")


def spark_sql(sql: str) -> str:
    return _spell(sql, SPARK, "`")


def duckdb_sql(sql: str) -> str:
    return _spell(sql, DUCKDB, '"')


def error_lists_sql() -> str:
    return ERROR_LISTS.replace("{logs}", EXECUTION_LOGS)


def base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A stand-in as a DataFrame over the driver's tables."""
    words = set(re.findall(r"\w+", sql))
    for table in BASE_TABLES:
        if table in words:
            base(spark, sf_dir, table).createOrReplaceTempView(table)
    return spark.sql(spark_sql(sql))


def _typed(df: DataFrame, columns: tuple[Column, ...]) -> DataFrame:
    """Rows as a table of the warehouse holds them: of the declared types."""
    return df.select(*[quoted(c.name).cast(_plain(c)).alias(c.name) for c in columns])


def _plain(column: Column) -> str:
    return "string" if column.max_length is not None else column.type


def fact_rows(spark: SparkSession, sf_dir: str, spec: TableSpec) -> str:
    """The rows that source and target of a fact are projected from, for ``rows`` of both.

    They are made once and lie by month, while they have few columns; the forty of the fact are not
    shuffled then. Columns that the fact is not projected from are left out.
    """
    rows = frame(spark, sf_dir, FACT_ROWS[spec.table])
    used = set(re.findall(r"\w+", source_sql(spec, "facts")))
    rows = rows.select(*[c for c in rows.columns if c in used or c == "day"])
    by_month = rows.withColumn(MONTH, month_start(F.col("day"))).hint("rebalance", MONTH).select(*rows.columns)
    name = f"{spec.table.lower()}_rows"
    tables.staged(by_month, name).createOrReplaceTempView(name)
    return f"SELECT * FROM {name}"


def source(spark: SparkSession, sf_dir: str, spec: TableSpec, rows: str | None = None) -> DataFrame:
    """What a fact load reads: a raw table, or the typed table of the tier before."""
    raw = frame(spark, sf_dir, source_sql(spec, rows))
    if "." not in spec.source:
        return raw
    tier, table = spec.source.split("_data.")
    return _typed(raw, SPECS[tier][table].columns)


def target(spark: SparkSession, sf_dir: str, spec: TableSpec, rows: str | None = None) -> DataFrame:
    return _typed(frame(spark, sf_dir, target_sql(spec, rows)), spec.columns)
