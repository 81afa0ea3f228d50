"""What each of the 39 loads reads, computes and writes.

Thirteen tables, each in the tiers dev, test and prod. A spec is plain data; the jobs in
``loads`` and the operators take everything they need from it.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column as SparkColumn, functions as F

from tidemark.functions.dates import days_between, plus_days
from tidemark.functions.names import business_name

TIERS = ("dev", "test", "prod")


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False

    @property
    def max_length(self) -> int | None:
        size = re.fullmatch(r"VARCHAR\((\d+)\)", self.type)
        return int(size[1]) if size else None


@dataclass(frozen=True)
class TableSpec:
    tier: str
    table: str
    source: str
    columns: tuple[Column, ...]
    # facts only
    event: str | None = None
    compare: tuple[str, ...] = ()
    compare_null_safe: tuple[str, ...] = ()
    never_updated: tuple[str, ...] = ()
    # facts only: files of a month are dealt by key into so many buckets, so that an increment too
    # large for a broadcast is shuffled alone and not the table; a reader has one task per bucket.
    # None by default, and fixed once a table is made.
    buckets: int = 0
    # source column -> target column, where they differ
    renames: dict[str, str] = field(default_factory=dict)
    # target column -> expression over the source, given the time of the run
    derived: dict[str, Callable[[SparkColumn], SparkColumn]] = field(default_factory=dict)

    @property
    def key(self) -> str:
        return next(c.name for c in self.columns if c.required)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def is_fact(self) -> bool:
        return self.event is not None

    @property
    def source_event(self) -> str | None:
        """The event column under its name in the source."""
        shown = {new: old for old, new in self.renames.items()}
        return shown.get(self.event, self.event)

    @property
    def schema_name(self) -> str:
        return f"{self.tier}_data"

    @property
    def full_name(self) -> str:
        return f"{self.schema_name}.{self.table}"


def _columns(ddl: str) -> tuple[Column, ...]:
    found = re.findall(r"(\w+) ([A-Z_]+(?:\([\d,]+\))?)( NOT NULL)?(?:,|\s*$)", ddl)
    return tuple(Column(name, kind, bool(required)) for name, kind, required in found)


# Columns and declared types of the dev tables, in table order. The row keys of
# the facts are BIGINT where the warehouse they come from declares INT: every INT fits, and
# more than 2^31 rows must have keys too.
ACCOUNTS = _columns(
    "Account_ID VARCHAR(255) NOT NULL, Account_Name VARCHAR(255), Account_Type VARCHAR(100), "
    "Financial_Statement VARCHAR(100)"
)
BUSINESS_LINES = _columns(
    "Business_Line_ID VARCHAR(255) NOT NULL, Business_Line_Name VARCHAR(255), "
    "Region VARCHAR(100), Status VARCHAR(50)"
)
CUSTOMERS = _columns(
    "Customer_ID VARCHAR(255) NOT NULL, Customer_Name VARCHAR(255), Customer_Type VARCHAR(100), "
    "Customer_Segment VARCHAR(100), City VARCHAR(100), Country VARCHAR(100), "
    "Registration_Date DATE, Credit_Limit DECIMAL(18,2), Is_Active BOOLEAN"
)
DATE = _columns(
    "Date_ID INT NOT NULL, Date DATE, Year INT, Quarter INT, Month INT, Month_Name VARCHAR(50), "
    "Week INT, Day INT, Day_of_Week INT, Day_Name VARCHAR(50), Is_Weekend BOOLEAN, "
    "Is_Holiday BOOLEAN"
)
DOCUMENTS = _columns(
    "Document_ID VARCHAR(255) NOT NULL, Document_Number VARCHAR(255), "
    "Document_Type VARCHAR(100), Document_Date DATE, Status VARCHAR(50)"
)
EMPLOYEES = _columns(
    "Employee_ID VARCHAR(255) NOT NULL, Employee_Name VARCHAR(255), Department VARCHAR(100), "
    "Position VARCHAR(100), Location VARCHAR(100), Hire_Date DATE, Salary DECIMAL(18,2), "
    "Is_Active BOOLEAN"
)
PRODUCTS = _columns(
    "Product_ID VARCHAR(255) NOT NULL, Product_Name VARCHAR(255), SKU VARCHAR(100), "
    "Category VARCHAR(100), Brand VARCHAR(100), Unit_Cost DECIMAL(18,2), "
    "Unit_Price DECIMAL(18,2), Weight_KG DECIMAL(18,2), Is_Active BOOLEAN, "
    "Markup_Pct DECIMAL(18,2)"
)
SUPPLIERS = _columns(
    "Supplier_ID VARCHAR(255) NOT NULL, Supplier_Name VARCHAR(255), Supplier_Type VARCHAR(100), "
    "Country VARCHAR(100), Payment_Terms VARCHAR(100), Quality_Rating INT, Is_Active BOOLEAN"
)
BUDGET = _columns(
    "Budget_ID BIGINT NOT NULL, Date_ID INT, Budget_Period DATE, Account_ID VARCHAR(255), "
    "Business_Line_ID VARCHAR(255), Employee_ID VARCHAR(255), Budget_Version VARCHAR(255), "
    "Budget_Type VARCHAR(255), Budget_Category VARCHAR(255), Cost_Center VARCHAR(255), "
    "Project_Code VARCHAR(255), Budgeted_Amount DECIMAL(38,2), Actual_Amount DECIMAL(38,2), "
    "Committed_Amount DECIMAL(38,2), Forecast_Amount DECIMAL(38,2), Budget_Owner VARCHAR(255), "
    "Approval_Status VARCHAR(255), Approved_By VARCHAR(255), Notes VARCHAR(1999), "
    "Approval_Date DATE, Last_Modified_Date DATE, Variance DECIMAL(38,2), "
    "Variance_Pct DECIMAL(38,10), Available_Budget DECIMAL(38,2), "
    "Utilization_Pct DECIMAL(38,10), Forecast_Variance DECIMAL(38,2)"
)
HR = _columns(
    "HR_ID BIGINT NOT NULL, Date_ID INT, Transaction_Date DATE, Employee_ID VARCHAR(255), "
    "Business_Line_ID VARCHAR(255), Account_ID VARCHAR(255), Transaction_Type VARCHAR(255), "
    "Payroll_Period VARCHAR(100), Payment_Method VARCHAR(100), Payment_Status VARCHAR(100), "
    "Amount DECIMAL(38,2), Hours_Worked DECIMAL(38,2), Overtime_Hours DECIMAL(38,2), "
    "Hourly_Rate DECIMAL(38,2), Gross_Amount DECIMAL(38,2), Bonus_Type VARCHAR(100), "
    "Training_Course VARCHAR(255), Travel_Destination VARCHAR(255), Cost_Center VARCHAR(255), "
    "Project_Code VARCHAR(255), Approved_By VARCHAR(255), Processed_By VARCHAR(255), "
    "Notes VARCHAR(1999), Approval_Date DATE, Processing_Date DATE, Tax_Amount DECIMAL(38,2), "
    "Social_Security DECIMAL(38,2), Health_Insurance DECIMAL(38,2), Net_Amount DECIMAL(38,2), "
    "Effective_Hourly_Rate DECIMAL(38,2)"
)
INVENTORY = _columns(
    "Inventory_ID BIGINT NOT NULL, Date_ID INT, Transaction_DateTime TIMESTAMP_NTZ, "
    "Document_ID VARCHAR(255), Product_ID VARCHAR(255), Supplier_ID VARCHAR(255), "
    "Customer_ID VARCHAR(255), Employee_ID VARCHAR(255), Business_Line_ID VARCHAR(255), "
    "Movement_Type VARCHAR(255), Transaction_Number VARCHAR(255), "
    "Reference_Document VARCHAR(255), Warehouse_From VARCHAR(255), Warehouse_To VARCHAR(255), "
    "Storage_Location VARCHAR(255), Quantity DECIMAL(38,2), Unit_Cost DECIMAL(38,2), "
    "Quantity_Before DECIMAL(38,2), Batch_Number VARCHAR(255), Serial_Number VARCHAR(255), "
    "Quality_Status VARCHAR(100), Reason_Code VARCHAR(100), Shipping_Method VARCHAR(100), "
    "Tracking_Number VARCHAR(255), Freight_Cost DECIMAL(38,2), Processed_By VARCHAR(255), "
    "Approved_By VARCHAR(255), Is_Verified INT, Notes VARCHAR(1999), Expiry_Date DATE, "
    "Manufacturing_Date DATE, Verification_Date DATE, Quantity_After DECIMAL(38,2), "
    "Total_Value DECIMAL(38,2), Stock_Value_Before DECIMAL(38,2), "
    "Stock_Value_After DECIMAL(38,2), Days_To_Expiry INT, Product_Age_Days INT"
)
PURCHASES = _columns(
    "Purchase_ID BIGINT NOT NULL, Purchase_Line_Number INT, Date_ID INT, "
    "Transaction_Date TIMESTAMP_NTZ, Document_ID VARCHAR(255), Product_ID VARCHAR(255), "
    "Supplier_ID VARCHAR(255), Employee_ID VARCHAR(255), Business_Line_ID VARCHAR(255), "
    "Account_ID VARCHAR(255), PO_Number VARCHAR(255), Supplier_Invoice_Number VARCHAR(255), "
    "Purchase_Type VARCHAR(100), Payment_Terms VARCHAR(100), Payment_Status VARCHAR(100), "
    "Delivery_Status VARCHAR(100), Quantity_Ordered DECIMAL(38,2), "
    "Quantity_Received DECIMAL(38,2), Unit_Cost DECIMAL(38,2), Freight_Cost DECIMAL(38,2), "
    "Tax_Pct DECIMAL(38,2), Warehouse_Destination VARCHAR(255), Incoterms VARCHAR(100), "
    "Currency VARCHAR(10), Exchange_Rate DECIMAL(38,4), Quality_Check_Status VARCHAR(100), "
    "Defect_Rate_Pct DECIMAL(38,2), Approved_By VARCHAR(255), Received_By VARCHAR(255), "
    "Notes VARCHAR(1999), Expected_Delivery_Date DATE, Actual_Delivery_Date DATE, "
    "Net_Amount DECIMAL(38,2), Tax_Amount DECIMAL(38,2), Total_Amount DECIMAL(38,2), "
    "Total_Amount_RON DECIMAL(38,2), Quantity_Variance DECIMAL(38,2), Delivery_Delay_Days INT"
)
SALES = _columns(
    "Sales_ID BIGINT NOT NULL, Sales_Line_Number INT, Date_ID INT, "
    "Transaction_DateTime TIMESTAMP_NTZ, Document_ID VARCHAR(255), Product_ID VARCHAR(255), "
    "Customer_ID VARCHAR(255), Employee_ID VARCHAR(255), Business_Line_ID VARCHAR(255), "
    "Account_ID VARCHAR(255), Order_Number VARCHAR(255), Invoice_Number VARCHAR(255), "
    "Sales_Channel VARCHAR(100), Payment_Method VARCHAR(100), Payment_Status VARCHAR(100), "
    "Delivery_Method VARCHAR(100), Quantity DECIMAL(38,2), Unit_Price DECIMAL(38,2), "
    "Unit_Cost DECIMAL(38,2), Discount_Pct DECIMAL(38,2), Tax_Pct DECIMAL(38,2), "
    "Promotion_Code VARCHAR(100), Customer_Segment_Override VARCHAR(100), "
    "Sales_Region VARCHAR(100), Warehouse_Location VARCHAR(255), Created_By VARCHAR(255), "
    "Modified_By VARCHAR(255), Is_Return INT, Return_Reason VARCHAR(255), Notes VARCHAR(1999), "
    "Gross_Amount DECIMAL(38,2), Discount_Amount DECIMAL(38,2), Net_Amount DECIMAL(38,2), "
    "Tax_Amount DECIMAL(38,2), Total_Amount DECIMAL(38,2), Cost_Amount DECIMAL(38,2), "
    "Profit_Amount DECIMAL(38,2), Profit_Margin_Pct DECIMAL(38,2), Created_Date TIMESTAMP_NTZ, "
    "Modified_Date TIMESTAMP_NTZ"
)

# Days from a purchase to its approval.
APPROVAL_DAYS = 2

# Names of the tables and their sources, the event of each fact, the columns whose
# change updates a row, and those never updated. In load order: facts first, then dimensions.
DEV = {
    spec.table: spec
    for spec in (
        TableSpec(
            "dev", "Budget", "fact_budget", BUDGET, "Last_Modified_Date",
            ("Last_Modified_Date", "Actual_Amount", "Budgeted_Amount"), ("Approval_Status",),
        ),
        TableSpec(
            "dev", "Hr", "fact_hr", HR, "Processing_Date",
            ("Processing_Date", "Net_Amount", "Payment_Status", "Hours_Worked"),
            never_updated=("Hourly_Rate",),
        ),
        TableSpec(
            "dev", "Inventory", "fact_inventory", INVENTORY, "Transaction_DateTime",
            ("Transaction_DateTime", "Quantity", "Total_Value", "Is_Verified"),
        ),
        TableSpec(
            "dev", "Purchases", "fact_purchases", PURCHASES, "Transaction_Date",
            ("Transaction_Date", "Total_Amount", "Delivery_Status"),
        ),
        TableSpec(
            "dev", "Sales", "fact_sales", SALES, "Transaction_DateTime",
            ("Transaction_DateTime", "Total_Amount", "Payment_Status"),
        ),
        TableSpec("dev", "Accounts", "dim_accounts", ACCOUNTS),
        TableSpec("dev", "BusinessLines", "dim_business_lines", BUSINESS_LINES),
        TableSpec("dev", "Customers", "dim_customers", CUSTOMERS),
        TableSpec("dev", "Products", "dim_products", PRODUCTS),
        TableSpec("dev", "Employees", "dim_employees", EMPLOYEES),
        TableSpec("dev", "Suppliers", "dim_suppliers", SUPPLIERS),
        TableSpec("dev", "Documents", "dim_documents", DOCUMENTS),
        TableSpec("dev", "Date", "dim_date", DATE),
    )
}


def _test_tier() -> dict[str, TableSpec]:
    """The dev loads again, except where test adds columns or reads the dev tier."""
    specs = {name: replace(spec, tier="test") for name, spec in DEV.items()}
    age = lambda as_of: days_between(F.col("Transaction_DateTime"), as_of)
    specs["Sales"] = replace(
        specs["Sales"],
        source="dev_data.Sales",
        columns=SALES + _columns("Days_Outstanding INT, Delivery_Days INT"),
        derived={"Days_Outstanding": age, "Delivery_Days": age},
    )
    specs["Purchases"] = replace(
        specs["Purchases"],
        columns=PURCHASES + _columns("Approval_Date TIMESTAMP_NTZ"),
        derived={
            "Approval_Date": lambda as_of: plus_days(F.col("Transaction_Date"), APPROVAL_DAYS)
        },
    )
    specs["Products"] = replace(
        specs["Products"],
        source="dev_data.Products",
        columns=PRODUCTS + _columns("Launch_Date TIMESTAMP_NTZ"),
    )
    return specs


def _prod_tier(test: dict[str, TableSpec]) -> dict[str, TableSpec]:
    """Every test table under business names."""
    specs = {}
    for table, spec in test.items():
        dimension_key = None if spec.is_fact else spec.key
        shown = {name: business_name(name, dimension_key) for name in spec.names}
        specs[table] = replace(
            spec,
            tier="prod",
            source=spec.full_name,
            columns=tuple(replace(c, name=shown[c.name]) for c in spec.columns),
            event=shown.get(spec.event),
            compare=tuple(shown[c] for c in spec.compare),
            compare_null_safe=tuple(shown[c] for c in spec.compare_null_safe),
            never_updated=(),
            renames={old: new for old, new in shown.items() if old != new},
            derived={},
        )
    return specs


TEST = _test_tier()
PROD = _prod_tier(TEST)
SPECS = {"dev": DEV, "test": TEST, "prod": PROD}


def spec(tier: str, table: str) -> TableSpec:
    return SPECS[tier][table]
