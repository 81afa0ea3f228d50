"""The sample queries run after an ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

NEWEST_DATES = 10
SAMPLE_ROWS = 5


def sales_by_date(sales: DataFrame, newest: int | None = NEWEST_DATES) -> DataFrame:
    """Number, amount and profit of sales by date, newest dates first."""
    by_date = (
        sales.groupBy("Date_ID")
        .agg(
            F.count(F.lit(1)).alias("Transaction_Count"),
            F.sum("Total_Amount").alias("Total_Sales"),
            F.sum("Profit_Amount").alias("Total_Profit"),
        )
        .orderBy(F.desc("Date_ID"))
    )
    return by_date if newest is None else by_date.limit(newest)


def inventory_movements(inventory: DataFrame) -> DataFrame:
    """Quantity and number of movements by product and kind."""
    return inventory.groupBy("Product_ID", "Movement_Type").agg(
        F.sum("Quantity").alias("Total_Quantity"), F.count(F.lit(1)).alias("Movement_Count")
    )


def active(dimension: DataFrame) -> DataFrame:
    return dimension.where(F.col("Is_Active").cast("boolean"))


def active_products(products: DataFrame) -> DataFrame:
    return active(products).select(
        "Product_ID", "Product_Name", "Category", "Brand", "Unit_Price"
    )


def sample(df: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Any few rows."""
    return df.limit(rows)
