"""Direct SKU match and keyword overrides (wholesale)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planmatch import config as C
from planmatch.config import WHOLESALE, WholesaleRules
from planmatch.functions.text import strip_ws


def direct_sku_match(df: DataFrame, sku_col: str = "PRODUCTSKU") -> DataFrame:
    """The SKU is the planning category; a null SKU is labelled 'Missing SKU'."""
    sku = F.col(sku_col)
    has = sku.isNotNull()
    return df.withColumns({
        "MATCHED_SNOP_CATEGORY": F.when(has, sku),
        "MATCH_SCORE": F.when(has, F.lit(100.0)),
        "MATCHED_REFERENCE": F.when(has, F.lit(C.REF_WHOLESALE)),
        "MATCH_RESULT": F.when(has, F.lit(C.LABEL_WHOLESALE)).otherwise(F.lit(C.LABEL_MISSING_SKU)),
    })


def trim_bulk_override(df: DataFrame, rules: WholesaleRules = WHOLESALE) -> DataFrame:
    """Rows without a category (null or blank): TRIM, then BULK in the name assign a bulk category."""
    cat = F.col("MATCHED_SNOP_CATEGORY")
    missing = cat.isNull() | (strip_ws(cat) == "")
    name = F.upper(F.coalesce(F.col("PRODUCTNAME"), F.lit("None")))
    brand = F.upper(F.coalesce(F.col("BRANDNAME"), F.lit("None")))
    premium = brand.contains(rules.premium_keyword) | name.contains(rules.premium_keyword)
    trim = missing & name.contains(rules.trim_word)
    bulk = missing & ~name.contains(rules.trim_word) & name.contains(rules.bulk_word)
    hit = trim | bulk
    kind = F.when(trim, F.lit("trim")).otherwise(F.lit("bulk"))
    return df.withColumns({
        "MATCHED_SNOP_CATEGORY": F.when(hit & premium, F.lit(rules.premium_category))
        .when(hit, F.lit(rules.default_category)).otherwise(cat),
        "MATCH_SCORE": F.when(hit & premium, F.lit(95.0)).when(hit, F.lit(90.0)).otherwise(F.col("MATCH_SCORE")),
        "MATCHED_REFERENCE": F.when(hit & premium, F.concat(kind, F.lit(" name brand rule")))
        .when(hit, F.concat(kind, F.lit(" name rule"))).otherwise(F.col("MATCHED_REFERENCE")),
        "MATCH_RESULT": F.when(trim, F.lit(C.LABEL_TRIM)).when(bulk, F.lit(C.LABEL_BULK))
        .otherwise(F.col("MATCH_RESULT")),
    })
