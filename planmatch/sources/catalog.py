"""Catalog (product -> planning category) derivations.

The original builds dictionaries where the *last* duplicate wins and lists
whose order is the tie-break; here the catalog carries an explicit position
column and every derivation is an aggregate over it:

* ``exact_map``      name -> category, nulls dropped first (sales) or kept (inventory), last wins
* ``reference_names`` distinct fuzzy keys with first position, last category, features
* ``category_list``  distinct lower-cased categories with first position
* ``fallback_rows``  per catalog row attributes for the preroll fallback
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planmatch.config import RuleSet
from planmatch.functions import text as TX
from planmatch.sources.extract import require_columns, strip_column_names

POS = "CATALOGPOS"


def prepare_catalog(catalog: DataFrame, pos_col: str = POS) -> DataFrame:
    """Strip header whitespace, check PRODUCTNAME, expose the ordering column as POS.

    Without an explicit position column, the name itself is the order.
    """
    catalog = require_columns(strip_column_names(catalog), "PRODUCTNAME")
    if "SNOPCATEGORY" not in catalog.columns:
        catalog = catalog.withColumn("SNOPCATEGORY", F.lit(None).cast("string"))
    pos = F.col(pos_col) if pos_col in catalog.columns else F.col("PRODUCTNAME")
    return catalog.withColumn("POS", pos)


def exact_map(catalog: DataFrame, rules: RuleSet) -> DataFrame:
    """EXACT_KEY -> CAT.  Sales: raw names, null categories dropped before last-wins.
    Inventory: normalised names, last wins including null."""
    if rules.normalized_keys:
        keyed = catalog.select(TX.normalize_text(TX.clean_text("PRODUCTNAME", rules)).alias("KEY"), "SNOPCATEGORY", "POS")
    else:
        keyed = catalog.filter(F.col("SNOPCATEGORY").isNotNull() & F.col("PRODUCTNAME").isNotNull()).select(
            F.col("PRODUCTNAME").alias("KEY"), "SNOPCATEGORY", "POS")
    return keyed.groupBy("KEY").agg(F.max_by("SNOPCATEGORY", "POS").alias("CAT"))


def reference_names(catalog: DataFrame, rules: RuleSet) -> DataFrame:
    """Fuzzy reference names with first position, last category and candidate features."""
    keyed = catalog.select(TX.reference_key("PRODUCTNAME", rules).alias("REF_KEY"), "SNOPCATEGORY", "POS")
    if not rules.normalized_keys:
        keyed = keyed.filter(F.col("REF_KEY").isNotNull())
    refs = keyed.groupBy("REF_KEY").agg(
        F.min("POS").alias("REF_POS"), F.max_by("SNOPCATEGORY", "POS").alias("REF_CAT"))
    return refs.select(
        "REF_KEY", "REF_POS", "REF_CAT",
        TX.token_sort_key("REF_KEY").alias("REF_TOKEN_KEY"),
        TX.extract_grams("REF_KEY").alias("REF_GRAMS"),
        TX.flavor_tokens("REF_KEY", rules).alias("REF_FLAVORS"),
        TX.flavor_string("REF_KEY", rules).alias("REF_FLAVOR_STR"),
        TX.pack_size("REF_KEY").alias("REF_PACK"),
    )


def category_list(catalog: DataFrame) -> DataFrame:
    """Distinct lower-cased categories (nulls dropped) with their first position."""
    return (
        catalog.filter(F.col("SNOPCATEGORY").isNotNull())
        .select(F.lower("SNOPCATEGORY").alias("CAT_LC"), "POS")
        .groupBy("CAT_LC")
        .agg(F.min("POS").alias("CAT_POS"))
    )


def fallback_rows(catalog: DataFrame, rules: RuleSet) -> DataFrame:
    """Catalog rows whose name mentions preroll, with strain, grams, pack and brand."""
    name_lc = TX.py_str_lower("PRODUCTNAME")
    if rules.catalog_brand_col and rules.catalog_brand_col in catalog.columns:
        brand = TX.py_str_lower(F.col(rules.catalog_brand_col).cast("string"))
    else:
        brand = F.lit("")
    return catalog.filter(name_lc.contains("preroll")).select(
        F.col("PRODUCTNAME").alias("FB_NAME"),
        F.col("SNOPCATEGORY").alias("FB_CAT"),
        F.col("POS").alias("FB_POS"),
        brand.alias("FB_BRAND"),
        TX.strain(name_lc).alias("FB_STRAIN"),
        TX.extract_grams(name_lc).alias("FB_GRAMS"),
        TX.pack_number(name_lc).alias("FB_PACK"),
    )
