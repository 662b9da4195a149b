"""Retail channel: brand gate, matching ladder on distinct keys, split and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planmatch import config as C
from planmatch.config import RuleSet
from planmatch.functions.text import strip_ws
from planmatch.operators import ladder as L
from planmatch.operators import report
from planmatch.operators.joins import null_safe_join, sized_broadcast, written

FEATURE_COLS = {
    "CLEANED": "CLEANED_PRODUCTNAME",
    "P_TYPE": "PRODUCTTYPE",
    "P_FLAVORS": "FLAVORTOKENS",
    "P_FLAVOR_STR": "FLAVORCLEANED",
    "P_STRAIN": "STRAINTYPE",
}

SALES_REQUIRED = ["LOCATIONNAME", "TRANSACTIONDATE", "MATCHED_SNOP_CATEGORY", "PRODUCTNAME", "TOTAL_QUANTITY",
                  "TOTAL_REVENUE", "WEIGHTSOLD", "MATCH_RESULT", "MATCH_SCORE", "MATCHED_REFERENCE"]


def brand_gate(df: DataFrame, rules: RuleSet) -> DataFrame:
    """APPROVED flag: no second scan, rejected rows stay and are labelled later."""
    if rules.gate_case_insensitive:
        brand = F.lower(strip_ws(F.coalesce(F.col("BRANDNAME").cast("string"), F.lit("None"))))
        ok = brand.isin(sorted({b.lower() for b in rules.approved_brands}))
    else:
        ok = F.col("BRANDNAME").isin(list(rules.approved_brands))
    return df.withColumn("APPROVED", F.coalesce(ok, F.lit(False)))


def key_results(gated: DataFrame, catalog: L.Catalog, rules: RuleSet, checkpoint: bool = True) -> DataFrame:
    """The ladder over the distinct approved keys, materialised once.

    Written to the shared folder of ``spark.checkpoint.dir`` and read back: this
    cuts the lineage, so the fuzzy scoring never reruns for the split, summaries
    and accounting, nor after a lost executor, and the size is known afterwards.
    """
    keys = L.product_keys(gated.filter("APPROVED"), rules)
    res = L.match_keys(keys, catalog, rules)
    return written(res, "key-results") if checkpoint else res


def label_rows(gated: DataFrame, results: DataFrame, rules: RuleSet) -> DataFrame:
    """Join key results back to every row; wrong-brand rows get only their label."""
    cols = gated.columns
    forced = L.type_forced(rules) if ("CATEGORY" in cols and "MASTERCATEGORY" in cols) else F.lit(False)
    facts = gated.withColumn("TYPE_FORCED", forced)
    keep = L.KEY + ["P_GRAMS", *FEATURE_COLS] + L.MATCH_COLS
    if "FAILED_CHECKS" in results.columns:
        keep.append("FAILED_CHECKS")
    small, _ = sized_broadcast(results.select(*keep))
    out = null_safe_join(facts, small, L.KEY)
    approved = F.col("APPROVED")
    out = out.withColumn("MATCH_RESULT", F.when(approved, F.col("MATCH_RESULT")).otherwise(F.lit(C.LABEL_WRONG_BRAND)))
    if "PRODUCTGRAMS" in out.columns:
        # the source weight is summed as WEIGHTSOLD; the output column carries the parsed one
        out = out.withColumn("PRODUCTGRAMS", F.when(approved, F.col("P_GRAMS")).otherwise(F.col("PRODUCTGRAMS")))
    return out.drop("P_GRAMS", "TYPE_FORCED").withColumnsRenamed(FEATURE_COLS)


def sales_matched_mask():
    return F.col("APPROVED") & report.is_matched(blank="empty")


def inventory_matched_mask():
    return F.col("APPROVED") & report.is_matched()


def with_status(labelled: DataFrame, mask) -> DataFrame:
    return labelled.withColumn("STATUS", F.when(mask, F.lit("matched")).otherwise(F.lit("unmatched")))


def split_sales(labelled: DataFrame):
    """(matched_final, unmatched_final): matched keeps the output layout, unmatched keeps everything.

    The layout's PRODUCT.. and BRAND.. columns are the source's; features that the ladder adds are not part of it.
    """
    added = [*SALES_REQUIRED, *FEATURE_COLS.values()]
    extra = [c for c in labelled.columns if c.startswith(("PRODUCT", "BRAND")) and c not in added]
    m = sales_matched_mask()
    matched = labelled.filter(m).select(*SALES_REQUIRED, *extra)
    unmatched = labelled.filter(~m)
    return matched, unmatched


def inventory_quantity(labelled: DataFrame) -> DataFrame:
    qty = F.coalesce(F.col("QUANTITYAVAILABLE").try_cast("double"), F.lit(0.0)) \
        if "QUANTITYAVAILABLE" in labelled.columns else F.lit(0.0)
    return labelled.withColumn("TOTAL_QUANTITY", qty)


def split_inventory(labelled: DataFrame):
    m = inventory_matched_mask()
    out = inventory_quantity(labelled)
    return out.filter(m), out.filter(~m)


def sales_category_summary(labelled: DataFrame) -> DataFrame:
    matched, _ = split_sales(labelled)
    return report.category_summary(matched)


def sales_daily_summary(labelled: DataFrame) -> DataFrame:
    matched, _ = split_sales(labelled)
    return report.daily_summary(matched)
