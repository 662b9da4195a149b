"""Channel alignment and union."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Output names of the original tables (spaces and '&' included).
REFERENCE_NAMES = {
    "MATCHED_SNOP_CATEGORY": "Matched S&OP Category",
    "MATCH_SCORE": "Match Score",
    "MATCH_RESULT": "Match Result",
    "MATCHED_REFERENCE": "Matched Reference",
}

SALES_OUTPUT = ["LOCATIONNAME", "TRANSACTIONDATE", "MATCHED_SNOP_CATEGORY", "PRODUCTNAME", "BRANDNAME",
                "TOTAL_QUANTITY", "TOTAL_REVENUE", "MATCH_RESULT", "MATCH_SCORE", "MATCHED_REFERENCE"]
INVENTORY_OUTPUT = ["LOCATIONNAME", "INVENTORYDATE", "MATCHED_SNOP_CATEGORY", "PRODUCTNAME", "BRANDNAME",
                    "TOTAL_QUANTITY", "MATCH_RESULT", "MATCH_SCORE", "MATCHED_REFERENCE"]


def to_reference_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in REFERENCE_NAMES.items() if k in df.columns})


def align_columns(df1: DataFrame, df2: DataFrame, force: tuple = (), order: list | None = None):
    """Keep the common columns (plus ``force`` ones, null-filled where missing), same order on both."""
    common = [c for c in df1.columns if c in set(df2.columns)]
    for f in force:
        if f not in common and (f in df1.columns or f in df2.columns):
            common.append(f)
            if f not in df1.columns:
                df1 = df1.withColumn(f, F.lit(None).cast(df2.schema[f].dataType))
            if f not in df2.columns:
                df2 = df2.withColumn(f, F.lit(None).cast(df1.schema[f].dataType))
    if order is not None:
        common = [c for c in order if c in common] + [c for c in common if c not in order]
    return df1.select(*common), df2.select(*common)


def union_channels(df1: DataFrame, df2: DataFrame, force: tuple = ("TOTAL_QUANTITY",), order: list | None = None,
                   keep_raw: str | None = None) -> DataFrame:
    """Both channels in their common columns; the quantity becomes a number, or null where it is none.

    ``keep_raw`` names a column that holds the quantity as it was.
    """
    a, b = align_columns(df1, df2, force, order)
    out = a.unionByName(b)
    if "TOTAL_QUANTITY" in out.columns:
        if keep_raw:
            out = out.withColumn(keep_raw, F.col("TOTAL_QUANTITY"))
        out = out.withColumn("TOTAL_QUANTITY", F.col("TOTAL_QUANTITY").try_cast("double"))
    return out
