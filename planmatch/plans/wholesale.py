"""Wholesale channel: the SKU is the category; units converted to a common count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planmatch import config as C
from planmatch.config import WHOLESALE, WholesaleRules
from planmatch.functions.units import inventory_unit_count, sales_unit_count
from planmatch.operators import report
from planmatch.operators.overrides import direct_sku_match, trim_bulk_override
from planmatch.sources.extract import wholesale_inventory_snapshot, wholesale_sales_extract

SALES_FINAL = ["LOCATIONNAME", "TRANSACTIONDATE", "MATCHED_SNOP_CATEGORY", "PRODUCTNAME", "TOTAL_REVENUE",
               "UNIT_COUNT", "MATCH_RESULT", "MATCH_SCORE", "MATCHED_REFERENCE", "PRODUCTSKU", "BRANDNAME"]
INVENTORY_FINAL = ["LOCATIONNAME", "INVENTORYDATE", "MATCHED_SNOP_CATEGORY", "PRODUCTNAME", "TOTAL_QUANTITY",
                   "MATCH_RESULT", "MATCH_SCORE", "MATCHED_REFERENCE", "BRANDNAME"]


def labelled_sales(sales: DataFrame, rules: WholesaleRules = WHOLESALE, as_of=None, days: int = 90) -> DataFrame:
    """Extract -> UNIT_COUNT -> direct SKU match (all rows, labelled)."""
    ext = wholesale_sales_extract(sales, rules, as_of, days)
    return direct_sku_match(ext.withColumn("UNIT_COUNT", sales_unit_count(rules)))


def sales_table(labelled: DataFrame) -> DataFrame:
    """All rows in the output layout."""
    return labelled.select(*SALES_FINAL).withColumnRenamed("UNIT_COUNT", "TOTAL_QUANTITY")


def split_sales(labelled: DataFrame):
    """(matched, unmatched) in the output layout; an empty SKU counts as matched."""
    has = report.is_matched(blank="matched")
    out = sales_table(labelled)
    return out.filter(has), out.filter(~has)


def sales_category_summary(labelled: DataFrame, rules: WholesaleRules = WHOLESALE) -> DataFrame:
    matched = labelled.filter(F.col("MATCHED_SNOP_CATEGORY").isNotNull())
    summ = report.category_summary(matched, ("UNIT_COUNT", "TOTAL_REVENUE"))
    return summ.select(F.lit(rules.location).alias("LOCATIONNAME"), *summ.columns)


def sales_daily_summary(labelled: DataFrame) -> DataFrame:
    matched = labelled.filter(F.col("MATCHED_SNOP_CATEGORY").isNotNull())
    return report.daily_summary(matched, ("UNIT_COUNT", "TOTAL_REVENUE"))


def inventory_all_columns(inventory: DataFrame, rules: WholesaleRules = WHOLESALE) -> DataFrame:
    """Latest snapshot -> TOTAL_QUANTITY -> direct SKU match -> TRIM/BULK overrides (source columns kept)."""
    snap = wholesale_inventory_snapshot(inventory, rules)
    conv = snap.withColumn("TOTAL_QUANTITY", inventory_unit_count(rules))
    return trim_bulk_override(direct_sku_match(conv), rules)


def labelled_inventory(inventory: DataFrame, rules: WholesaleRules = WHOLESALE) -> DataFrame:
    return inventory_all_columns(inventory, rules).select(*INVENTORY_FINAL)


def inventory_controls(inventory: DataFrame, rules: WholesaleRules = WHOLESALE) -> DataFrame:
    """Control totals in one aggregate: quantity before and after conversion,
    TRIM rows, overrides applied, rows left without a category, null totals."""
    df = inventory_all_columns(inventory, rules)
    name = F.upper(F.coalesce(F.col("PRODUCTNAME"), F.lit("")))
    label = F.col("MATCH_RESULT")
    return df.agg(
        F.count(F.lit(1)).alias("ROWS"),
        F.coalesce(F.sum("QUANTITYONHAND"), F.lit(0.0)).alias("QUANTITY_BEFORE"),
        F.coalesce(F.sum("TOTAL_QUANTITY"), F.lit(0.0)).alias("QUANTITY_AFTER"),
        F.sum(F.when(name.contains(rules.trim_word), 1).otherwise(0)).cast("long").alias("TRIM_ROWS"),
        F.sum(F.when(label.isin(C.LABEL_TRIM, C.LABEL_BULK), 1).otherwise(0)).cast("long").alias("OVERRIDES"),
        F.sum(F.when(~report.is_matched(), 1).otherwise(0)).cast("long").alias("UNMATCHED_ROWS"),
        F.sum(F.when(F.col("TOTAL_QUANTITY").isNull(), 1).otherwise(0)).cast("long").alias("NULL_TOTAL_QUANTITY"),
    )
