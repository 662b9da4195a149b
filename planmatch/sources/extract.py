"""Source extracts: filters and roll-ups that the warehouse query used to do.

Everything is declarative so Catalyst pushes the filters and the column list
into the parquet scan and plans the roll-ups as partial + final aggregates.
``as_of`` is always a parameter (a date, a string or a Column); ``None`` means
"the latest date present in the data", found first by one job over the date
column.  The bounds are then literals: Catalyst turns the comparison of a
timestamp's date into a half-open range on the raw column and pushes it into
the scan (row groups outside are skipped; a table partitioned by date reads
only the partitions inside).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planmatch.config import WHOLESALE, RuleSet, WholesaleRules


def strip_column_names(df: DataFrame) -> DataFrame:
    """Remove surrounding whitespace from column names (no job is run)."""
    return df.toDF(*[c.strip() for c in df.columns])


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"missing required column(s): {missing}")
    return df


def as_date(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("date")


def as_of_column(df: DataFrame, date_col: str, as_of=None) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if as_of is None:
        as_of = df.agg(F.max(as_date(date_col))).first()[0]
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(as_of).cast("date")


def trailing_window(df: DataFrame, date_col: str, as_of=None, days: int = 90) -> Column:
    """Closed range [as_of - days, as_of] on the date column."""
    end = as_of_column(df, date_col, as_of)
    return as_date(date_col).between(F.date_sub(end, days), end)


def retail_sales_extract(sales: DataFrame, rules: RuleSet, as_of=None, days: int = 90) -> DataFrame:
    """Retail sales lines -> one row per product / location / day."""
    sales = strip_column_names(sales)
    void = F.lower(F.col("ISVOID").cast("string"))
    keep = (
        (F.lower(F.col("TRANSACTIONTYPE")) == F.lit("retail"))
        & trailing_window(sales, "TRANSACTIONDATE", as_of, days)
        & F.col("MASTERCATEGORY").isin(list(rules.master_categories))
        & F.col("RETURNDATE").isNull()
        & (void == F.lit("false"))
    )
    keys = ["LOCATIONNAME", "PRODUCTID", "PRODUCTNAME", "PRODUCTGRAMS", "SKU",
            "MASTERCATEGORY", "BRANDNAME", "CATEGORY", "TRANSACTIONDATE"]
    return (
        sales.filter(keep)
        .withColumn("TRANSACTIONDATE", as_date("TRANSACTIONDATE"))
        .groupBy(*keys)
        .agg(
            F.sum("PRODUCTGRAMS").alias("WEIGHTSOLD"),
            F.count_distinct("TRANSACTIONID").alias("TOTAL_TRANSACTIONS"),
            F.sum("QUANTITY").alias("TOTAL_QUANTITY"),
            F.sum("NETSALEFORITEM").alias("TOTAL_REVENUE"),
            F.avg("UNITCOST").alias("AVG_UNIT_COST"),
        )
        .select("LOCATIONNAME", "PRODUCTID", "PRODUCTNAME", "SKU", "MASTERCATEGORY", "BRANDNAME",
                "PRODUCTGRAMS", "WEIGHTSOLD", "CATEGORY", "TRANSACTIONDATE", "TOTAL_TRANSACTIONS",
                "TOTAL_QUANTITY", "TOTAL_REVENUE", "AVG_UNIT_COST")
    )


def wholesale_sales_extract(sales: DataFrame, rules: WholesaleRules = WHOLESALE, as_of=None,
                            days: int = 90) -> DataFrame:
    """Wholesale delivery lines -> one row per product / buyer / day, internal buyers excluded."""
    sales = strip_column_names(sales)
    keep = trailing_window(sales, "DELIVERYDATE", as_of, days) & ~F.lower(F.col("BUYERNAME")).isin(
        list(rules.excluded_buyers)
    )
    keys = ["DELIVERYDATE", "PRODUCTNAME", "BRAND", "PRODUCTSKU", "WEIGHTUNIT", "UNITSPERCASE", "BUYERNAME"]
    return (
        sales.filter(keep)
        .withColumn("DELIVERYDATE", as_date("DELIVERYDATE"))
        .groupBy(*keys)
        .agg(F.sum("QUANTITY").alias("QUANTITY"), F.sum("LINETOTAL").alias("TOTAL_REVENUE"))
        .select(
            F.lit(rules.location).alias("LOCATIONNAME"),
            F.col("DELIVERYDATE").alias("TRANSACTIONDATE"),
            "PRODUCTNAME",
            F.col("BRAND").alias("BRANDNAME"),
            "PRODUCTSKU",
            "WEIGHTUNIT",
            "UNITSPERCASE",
            F.col("PRODUCTSKU").alias("SNOP_CATEGORY"),
            "BUYERNAME",
            "QUANTITY",
            "TOTAL_REVENUE",
        )
    )


def latest_snapshot(df: DataFrame, date_col: str = "INVENTORYDATE") -> DataFrame:
    """Rows of the latest snapshot date; the max is taken over all rows first."""
    return df.filter(as_date(date_col) == as_of_column(df, date_col))


def retail_inventory_snapshot(inv: DataFrame, rules: RuleSet) -> DataFrame:
    inv = strip_column_names(inv)
    qty = F.col("QUANTITYAVAILABLE")
    return (
        latest_snapshot(inv)
        .filter(qty.isNotNull() & F.col("MASTERCATEGORY").isin(list(rules.master_categories)) & (qty > 0))
        .withColumn("INVENTORYDATE", as_date("INVENTORYDATE"))
    )


def wholesale_inventory_snapshot(inv: DataFrame, rules: WholesaleRules = WHOLESALE) -> DataFrame:
    inv = strip_column_names(inv)
    qty = F.col("QUANTITY")
    return latest_snapshot(inv).filter(qty.isNotNull() & (qty > 0) & ~F.col("PRODUCTARCHIVED")).select(
        F.lit(rules.location).alias("LOCATIONNAME"),
        "PRODUCTNAME",
        F.col("BRAND").alias("BRANDNAME"),
        "PRODUCTSKU",
        F.col("UNITSIZE").alias("WEIGHTUNIT"),
        "UNITSPERCASE",
        as_date("INVENTORYDATE").alias("INVENTORYDATE"),
        F.col("QUANTITY").alias("QUANTITYONHAND"),
    )
