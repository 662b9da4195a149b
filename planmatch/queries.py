"""Registered queries: one per operator group of the blueprint.

Each takes (spark, sf_dir), reads the driver tables through the fixture views
(whole tables) and returns a DataFrame.  Floating sums are rounded to 2
places (scores to 4) so the DuckDB oracle can compare them exactly; the
library functions themselves never round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmatch import config as C
from planmatch.config import FIXTURE_INVENTORY as INV
from planmatch.config import FIXTURE_SALES as SAL
from planmatch.config import FIXTURE_WHOLESALE as WHO
from planmatch.functions import text as TX
from planmatch.operators import combine, report
from planmatch.operators import ladder as L
from planmatch.operators.fuzzy import fuzzy_top_k
from planmatch.plans import retail, wholesale
from planmatch.plans import pipelines as P
from planmatch.sources import catalog as CAT
from planmatch.sources import extract as X
from planmatch.sources.fixtures import tables


def _round(df: DataFrame, cols, digits: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols if c in df.columns})


# --------------------------------------------------------------------------- M1


def _upc_double(df: DataFrame) -> DataFrame:
    # nullable integer -> double, so both engines hand over the same column type
    return df.withColumn("UNITSPERCASE", F.col("UNITSPERCASE").cast("double"))


def wholesale_extract(spark: SparkSession, sf: str) -> DataFrame:
    df = X.wholesale_sales_extract(tables(spark, sf).wholesale_sales, WHO)
    return _upc_double(_round(df, ["QUANTITY", "TOTAL_REVENUE"]))


def wholesale_units(spark: SparkSession, sf: str) -> DataFrame:
    df = wholesale.labelled_sales(tables(spark, sf).wholesale_sales, WHO)
    return _upc_double(_round(df, ["QUANTITY", "TOTAL_REVENUE", "UNIT_COUNT"]))


def wholesale_daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    df = wholesale.labelled_sales(tables(spark, sf).wholesale_sales, WHO)
    return _round(wholesale.sales_daily_summary(df), ["UNIT_COUNT", "TOTAL_REVENUE"])


def wholesale_category_summary(spark: SparkSession, sf: str) -> DataFrame:
    df = wholesale.labelled_sales(tables(spark, sf).wholesale_sales, WHO)
    return _round(wholesale.sales_category_summary(df, WHO), ["UNIT_COUNT", "TOTAL_REVENUE"])


# --------------------------------------------------------------------------- M2


def retail_extract(spark: SparkSession, sf: str) -> DataFrame:
    df = X.retail_sales_extract(tables(spark, sf).retail_sales, SAL)
    # revenue lines carry 4 decimals (price x (1 - discount)): rounded on that grid
    return _round(_round(df, ["WEIGHTSOLD", "TOTAL_QUANTITY"]), ["TOTAL_REVENUE", "AVG_UNIT_COST"], 4)


def retail_latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return X.retail_inventory_snapshot(tables(spark, sf).retail_inventory, INV)


def wholesale_latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return _upc_double(X.wholesale_inventory_snapshot(tables(spark, sf).wholesale_inventory, WHO))


# --------------------------------------------------------------------------- M3


def _names(spark, sf) -> DataFrame:
    return tables(spark, sf).product.select("PRODUCTNAME").distinct()


def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    return _names(spark, sf).select("PRODUCTNAME", TX.clean_text("PRODUCTNAME").alias("CLEANED"))


def normalize_names(spark: SparkSession, sf: str) -> DataFrame:
    names = _names(spark, sf).unionByName(tables(spark, sf).catalog.select("PRODUCTNAME")).distinct()
    return names.select("PRODUCTNAME", TX.normalize_text(TX.clean_text("PRODUCTNAME")).alias("NORMALIZED"))


def extract_grams(spark: SparkSession, sf: str) -> DataFrame:
    return _names(spark, sf).select("PRODUCTNAME", TX.extract_grams("PRODUCTNAME").alias("GRAMS"))


def product_type_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _names(spark, sf).select("PRODUCTNAME", TX.product_type("PRODUCTNAME", SAL).alias("PRODUCTTYPE"))


def product_type_inventory(spark: SparkSession, sf: str) -> DataFrame:
    p = tables(spark, sf).product.select("PRODUCTNAME", "CATEGORY", "MASTERCATEGORY").distinct()
    return p.select("PRODUCTNAME", "CATEGORY", "MASTERCATEGORY",
                    TX.product_type_with_override("PRODUCTNAME", "CATEGORY", "MASTERCATEGORY", INV).alias("PRODUCTTYPE"))


def flavor_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _names(spark, sf).select(
        "PRODUCTNAME",
        F.array_join(TX.flavor_tokens("PRODUCTNAME", SAL), "|").alias("TOKENS_SALES"),
        TX.flavor_string("PRODUCTNAME", SAL).alias("FLAVOR_SALES"),
        F.array_join(TX.flavor_tokens("PRODUCTNAME", INV), "|").alias("TOKENS_INVENTORY"),
        TX.flavor_string("PRODUCTNAME", INV).alias("FLAVOR_INVENTORY"),
    )


def strain_and_pack(spark: SparkSession, sf: str) -> DataFrame:
    return _names(spark, sf).select("PRODUCTNAME", TX.strain("PRODUCTNAME").alias("STRAIN"),
                                    TX.pack_size("PRODUCTNAME").alias("PACK"))


# --------------------------------------------------------------------------- M4


def _gated_sales_rows(spark, sf, rules=SAL) -> DataFrame:
    t = tables(spark, sf)
    rows = t.retail_sales.filter(F.col("MASTERCATEGORY").isin(list(rules.master_categories)))
    return retail.brand_gate(rows, rules)


def _keys(spark, sf, rules) -> DataFrame:
    t = tables(spark, sf)
    src = t.retail_sales if rules is SAL else t.retail_inventory
    rows = src.filter(F.col("MASTERCATEGORY").isin(list(rules.master_categories)))
    gated = retail.brand_gate(rows, rules).filter("APPROVED")
    return L.product_features(L.product_keys(gated, rules), rules)


def _catalog(spark, sf, rules) -> L.Catalog:
    return L.Catalog(tables(spark, sf).catalog, rules)


def _tier_out(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).select(
        "PRODUCTNAME", "BRANDNAME",
        F.col(f"{col}.cat").alias("MATCHED_SNOP_CATEGORY"), F.col(f"{col}.score").alias("MATCH_SCORE"),
        F.col(f"{col}.ref").alias("MATCHED_REFERENCE"), F.col(f"{col}.label").alias("MATCH_RESULT"))


def brand_gate(spark: SparkSession, sf: str) -> DataFrame:
    gated = _gated_sales_rows(spark, sf)
    return gated.groupBy("BRANDNAME", "APPROVED").agg(F.count(F.lit(1)).alias("ROWS"))


def exact_match(spark: SparkSession, sf: str) -> DataFrame:
    feats = _keys(spark, sf, SAL)
    return _tier_out(L.exact_tiers(feats, _catalog(spark, sf, SAL).exact), "T_EXACT")


def exact_match_brand(spark: SparkSession, sf: str) -> DataFrame:
    feats = _keys(spark, sf, SAL)
    return _tier_out(L.exact_tiers(feats, _catalog(spark, sf, SAL).exact), "T_ALT")


def token_key_match(spark: SparkSession, sf: str) -> DataFrame:
    feats = _keys(spark, sf, INV)
    return _tier_out(L.high_confidence_tier(feats, _catalog(spark, sf, INV).refs), "T_HIGH")


def name_exception_match(spark: SparkSession, sf: str) -> DataFrame:
    feats = _keys(spark, sf, INV)
    return _tier_out(L.exception_tier(feats, _catalog(spark, sf, INV).exact, INV), "T_EXCEPTION")


# --------------------------------------------------------------------------- M5


def fuzzy_top5(spark: SparkSession, sf: str) -> DataFrame:
    """Top-5 catalog names per cleaned sales name, for every candidate at or above 75."""
    texts = _keys(spark, sf, SAL).select("TOKEN_KEY").distinct()
    cat = _catalog(spark, sf, SAL)
    top = fuzzy_top_k(texts, cat.refs, SAL.strict_threshold, SAL.top_k)
    return top.select(
        "TOKEN_KEY", "REF_KEY", F.round("SCORE", 4).alias("SCORE"), F.col("RANK").cast("long").alias("RANK"))


def partial_best(spark: SparkSession, sf: str) -> DataFrame:
    """Edible backup: best partial ratio (>= 70) against the categories, all edible keys."""
    feats = _keys(spark, sf, SAL)
    out = L.backup_tier(feats, _catalog(spark, sf, SAL).categories, SAL)
    return _tier_out(out, "T_BACKUP").withColumn("MATCH_SCORE", F.round("MATCH_SCORE", 4))


# --------------------------------------------------------------------------- M6


def strict_match(spark: SparkSession, sf: str) -> DataFrame:
    feats = _keys(spark, sf, SAL)
    cat = _catalog(spark, sf, SAL)
    out = L.strict_tier(feats, cat.refs, SAL)
    return _tier_out(out, "T_STRICT").withColumn("MATCH_SCORE", F.round("MATCH_SCORE", 4))


def edible_backup(spark: SparkSession, sf: str) -> DataFrame:
    """The backup over all edible keys; what it gives those that the tiers before it leave open is in ``sales_ladder``."""
    return partial_best(spark, sf)


def preroll_fallback(spark: SparkSession, sf: str) -> DataFrame:
    feats = _keys(spark, sf, SAL)
    return _tier_out(L.fallback_tier(feats, _catalog(spark, sf, SAL).fallback), "T_FALLBACK")


def bulk_override(spark: SparkSession, sf: str) -> DataFrame:
    """Bulk override applied to every approved key as if unmatched (both presets)."""
    outs = []
    for rules in (SAL, INV):
        feats = _keys(spark, sf, rules)
        res = L.bulk_override(L._result(None, None, None, C.LABEL_NO_MATCH), rules)
        outs.append(feats.select(F.lit(rules.name).alias("PRESET"), "PRODUCTNAME", "BRANDNAME", "TYPE_FORCED",
                                 res.alias("R")).filter(F.col("R.label") == C.LABEL_BULK))
    u = outs[0].unionByName(outs[1])
    return u.select("PRESET", "PRODUCTNAME", "BRANDNAME", "TYPE_FORCED", F.col("R.cat").alias("MATCHED_SNOP_CATEGORY"),
                    F.col("R.score").alias("MATCH_SCORE"), F.col("R.ref").alias("MATCHED_REFERENCE"),
                    F.col("R.label").alias("MATCH_RESULT"))


def trim_bulk_override(spark: SparkSession, sf: str) -> DataFrame:
    return _round(wholesale.labelled_inventory(tables(spark, sf).wholesale_inventory, WHO), ["TOTAL_QUANTITY"])


def control_totals(spark: SparkSession, sf: str) -> DataFrame:
    df = wholesale.inventory_controls(tables(spark, sf).wholesale_inventory, WHO)
    return _round(df, ["QUANTITY_BEFORE", "QUANTITY_AFTER"])


def failed_checks(spark: SparkSession, sf: str) -> DataFrame:
    res = P.inventory_key_results(spark, sf)
    return res.filter(F.col("MATCH_RESULT") == C.LABEL_NO_MATCH).select(
        "PRODUCTNAME", "BRANDNAME", "TYPE_FORCED", "FAILED_CHECKS")


def sales_ladder(spark: SparkSession, sf: str) -> DataFrame:
    res = P.sales_key_results(spark, sf)
    return res.select("PRODUCTNAME", "BRANDNAME", *L.MATCH_COLS).withColumn("MATCH_SCORE", F.round("MATCH_SCORE", 4))


def inventory_ladder(spark: SparkSession, sf: str) -> DataFrame:
    res = P.inventory_key_results(spark, sf)
    return res.select("PRODUCTNAME", "BRANDNAME", "TYPE_FORCED", *L.MATCH_COLS, "FAILED_CHECKS").withColumn(
        "MATCH_SCORE", F.round("MATCH_SCORE", 4))


# --------------------------------------------------------------------------- M7


def category_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = P.retail_sales_outputs(spark, sf)
    return _round(_round(out["category_summary"], ["TOTAL_QUANTITY", "WEIGHTSOLD"]), ["TOTAL_REVENUE"], 4)


def daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = P.retail_sales_outputs(spark, sf)
    return _round(_round(out["daily_summary"], ["TOTAL_QUANTITY"]), ["TOTAL_REVENUE"], 4)


def match_rate(spark: SparkSession, sf: str) -> DataFrame:
    return report.match_rate(P.retail_sales_outputs(spark, sf)["labelled"])


def row_accounting(spark: SparkSession, sf: str) -> DataFrame:
    return P.accounting(spark, sf)


def combined_controls(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, quantity and null quantities of the combined tables, before and after the quantity's conversion."""
    return _round(P.combined_controls(spark, sf), ["QUANTITY_BEFORE", "QUANTITY_AFTER"])


def csv_exports(spark: SparkSession, sf: str) -> DataFrame:
    """The wholesale run's CSV files, read back."""
    return _round(P.wholesale_exports(spark, sf), ["QUANTITY", "REVENUE"])


def combined_sales(spark: SparkSession, sf: str) -> DataFrame:
    out = P.sales_run(spark, sf)
    m = out["matched"].withColumn("STATUS", F.lit("matched"))
    u = out["unmatched"].withColumn("STATUS", F.lit("unmatched"))
    # retail revenue lines carry 4 decimals; scores are rounded to 4 everywhere
    return _round(_round(m.unionByName(u), ["TOTAL_QUANTITY"]), ["TOTAL_REVENUE", "MATCH_SCORE"], 4)


def combined_inventory(spark: SparkSession, sf: str) -> DataFrame:
    out = P.inventory_run(spark, sf)
    m = out["matched"].withColumn("STATUS", F.lit("matched"))
    u = out["unmatched"].withColumn("STATUS", F.lit("unmatched"))
    return _round(_round(m.unionByName(u), ["TOTAL_QUANTITY"]), ["MATCH_SCORE"], 4)


def catalog_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Both name maps of a catalog with padded headers and many rows a name."""
    raw = tables(spark, sf).product.select(F.col("PRODUCTNAME").alias(" PRODUCTNAME "), F.col("PRODUCTSKU").alias("SNOPCATEGORY "),
                                           F.col("PRODUCTID").alias(f" {CAT.POS}"))
    cat = CAT.prepare_catalog(raw)
    exact = CAT.exact_map(cat, SAL).select(F.lit("exact").alias("MAP"), F.col("KEY").alias("NAME"), F.lit(None).cast("long").alias("FIRST_POS"),
                                           F.col("CAT").alias("CATEGORY"))
    names = CAT.reference_names(cat, SAL).select(F.lit("reference").alias("MAP"), F.col("REF_KEY").alias("NAME"), F.col("REF_POS").alias("FIRST_POS"),
                                                 F.col("REF_CAT").alias("CATEGORY"))
    return exact.unionByName(names)


def reference_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Two channels of which one has no quantity (forced, null), under the original's column names."""
    stock = wholesale.labelled_inventory(tables(spark, sf).wholesale_inventory, WHO)
    other = X.retail_inventory_snapshot(tables(spark, sf).retail_inventory, INV)
    other = other.withColumns({"MATCHED_SNOP_CATEGORY": F.col("CATEGORY"), "MATCH_RESULT": F.lit(C.LABEL_NO_MATCH)})
    return combine.to_reference_names(_round(combine.union_channels(stock, other), ["TOTAL_QUANTITY"]))


# --------------------------------------------------------------------------- M8


def sales_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Daily summaries of both channels, retail and wholesale."""
    retail_days = daily_summary(spark, sf).withColumn("CHANNEL", F.lit("retail"))
    wholesale_days = wholesale_daily_summary(spark, sf).withColumn("CHANNEL", F.lit("wholesale"))
    return retail_days.unionByName(wholesale_days, allowMissingColumns=True)


def inventory_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    out = P.inventory_run(spark, sf)
    return _round(_round(out["matched"], ["TOTAL_QUANTITY"]), ["MATCH_SCORE"], 4)


def window_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Both combined sales tables after a window reload over an older load: old rows before the window, new ones in it."""
    return _round(_round(P.reload_sales(spark, sf), ["TOTAL_QUANTITY"]), ["TOTAL_REVENUE", "MATCH_SCORE"], 4)


def snapshot_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Both combined inventory tables after a snapshot reload over an older load of two dates."""
    return _round(_round(P.reload_inventory(spark, sf), ["TOTAL_QUANTITY"]), ["MATCH_SCORE"], 4)


QUERIES = {
    "wholesale_extract": wholesale_extract,
    "wholesale_units": wholesale_units,
    "wholesale_daily_summary": wholesale_daily_summary,
    "wholesale_category_summary": wholesale_category_summary,
    "retail_extract": retail_extract,
    "retail_latest_snapshot": retail_latest_snapshot,
    "wholesale_latest_snapshot": wholesale_latest_snapshot,
    "clean_names": clean_names,
    "normalize_names": normalize_names,
    "extract_grams": extract_grams,
    "product_type_sales": product_type_sales,
    "product_type_inventory": product_type_inventory,
    "flavor_tokens": flavor_tokens,
    "strain_and_pack": strain_and_pack,
    "brand_gate": brand_gate,
    "exact_match": exact_match,
    "exact_match_brand": exact_match_brand,
    "token_key_match": token_key_match,
    "name_exception_match": name_exception_match,
    "fuzzy_top5": fuzzy_top5,
    "partial_best": partial_best,
    "strict_match": strict_match,
    "edible_backup": edible_backup,
    "catalog_last_wins": catalog_last_wins,
    "reference_layout": reference_layout,
    "preroll_fallback": preroll_fallback,
    "bulk_override": bulk_override,
    "trim_bulk_override": trim_bulk_override,
    "failed_checks": failed_checks,
    "control_totals": control_totals,
    "sales_ladder": sales_ladder,
    "inventory_ladder": inventory_ladder,
    "category_summary": category_summary,
    "daily_summary": daily_summary,
    "match_rate": match_rate,
    "row_accounting": row_accounting,
    "combined_controls": combined_controls,
    "csv_exports": csv_exports,
    "combined_sales": combined_sales,
    "combined_inventory": combined_inventory,
    "sales_pipeline": sales_pipeline,
    "inventory_pipeline": inventory_pipeline,
    "window_reload": window_reload,
    "snapshot_reload": snapshot_reload,
}
