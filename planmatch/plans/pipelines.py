"""End-to-end runs on the fixture tables (sales: E1, inventory: E2).

Every call evaluates its own ladder (the gated extract, which the keys and the rows come from, and the key results are
written once inside); a caller that wants several outputs of one run takes them from the returned dict.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmatch.config import FIXTURE_INVENTORY as INV
from planmatch.config import FIXTURE_SALES as SAL
from planmatch.config import FIXTURE_WHOLESALE as WHO
from planmatch.operators import combine, report
from planmatch.operators import ladder as L
from planmatch.operators.joins import written
from planmatch.plans import retail, wholesale
from planmatch.session import checkpoint_dir
from planmatch.sinks import export_csv, read_csv_export, read_table, snapshot_reload, window_reload
from planmatch.sources import extract as X
from planmatch.sources.fixtures import tables


def gated_sales(spark, sf, as_of=None):
    ext = X.retail_sales_extract(tables(spark, sf).retail_sales, SAL, as_of)
    return retail.brand_gate(ext, SAL)


def gated_inventory(spark, sf):
    snap = X.retail_inventory_snapshot(tables(spark, sf).retail_inventory, INV)
    return retail.brand_gate(snap, INV)


def sales_key_results(spark: SparkSession, sf: str, gated: DataFrame | None = None) -> DataFrame:
    cat = L.Catalog(tables(spark, sf).catalog, SAL)
    return retail.key_results(gated_sales(spark, sf) if gated is None else gated, cat, SAL)


def inventory_key_results(spark: SparkSession, sf: str, gated: DataFrame | None = None) -> DataFrame:
    cat = L.Catalog(tables(spark, sf).catalog, INV)
    return retail.key_results(gated_inventory(spark, sf) if gated is None else gated, cat, INV)


def retail_sales_outputs(spark: SparkSession, sf: str) -> dict:
    gated = written(gated_sales(spark, sf), "gated-sales")
    labelled = retail.label_rows(gated, sales_key_results(spark, sf, gated), SAL)
    matched, unmatched = retail.split_sales(labelled)
    return {
        "gated": gated,
        "labelled": labelled,
        "matched": matched,
        "unmatched": unmatched,
        "category_summary": report.category_summary(matched),
        "daily_summary": report.daily_summary(matched),
    }


def retail_inventory_outputs(spark: SparkSession, sf: str) -> dict:
    gated = written(gated_inventory(spark, sf), "gated-inventory")
    labelled = retail.label_rows(gated, inventory_key_results(spark, sf, gated), INV)
    matched, unmatched = retail.split_inventory(labelled)
    return {"gated": gated, "labelled": labelled, "matched": matched, "unmatched": unmatched}


def _run(gated: DataFrame, results: DataFrame, rules, mask, finish, other: DataFrame | None, order: list, name: str) -> dict:
    """One pass over the extract: label, split, combine, write once, partitioned by STATUS; counted while it is written.

    ``finish`` gives the labelled rows their quantity; ``other`` is the other channel with its STATUS.  The written
    rows are read back as two frames.  Raises if rows were lost or repeated on the way; a stage that ran again after
    a lost executor may have counted twice, so what looks wrong is counted again before.
    """
    spark = gated.sparkSession
    seen, source = report.observe_source(gated, f"{name}_source")
    labelled = retail.with_status(finish(retail.label_rows(seen, results, rules)), mask())
    labelled, output = report.observe_output(labelled, f"{name}_output")
    table = labelled.drop("APPROVED")
    if other is not None:
        table = combine.union_channels(table, other, order=[*order, "STATUS"], keep_raw="RAW_QUANTITY")
        table, controls = report.observe_controls(table, "RAW_QUANTITY", f"{name}_controls")
        table = table.drop("RAW_QUANTITY")
    path = f"{checkpoint_dir(spark).rstrip('/')}/run-{name}-{uuid.uuid4().hex}"
    table.write.partitionBy("STATUS").parquet(path)
    accounting_row = report.balanced({**source.get, **output.get})
    if not accounting_row["BALANCED"]:
        frames = retail.with_status(finish(retail.label_rows(gated, results, rules)), mask())
        accounting_row = report.row_accounting(gated, frames.filter("STATUS = 'matched'"), frames.filter("STATUS <> 'matched'")).first().asDict()
        report.assert_balanced(accounting_row)
    written = spark.read.schema(table.schema).parquet(path)
    frames = {s: written.filter(F.col("STATUS") == s).drop("STATUS") for s in ("matched", "unmatched")}
    return {**frames, "accounting": accounting_row, "controls": controls.get if other is not None else None}


def sales_run(spark: SparkSession, sf: str, combined: bool = True) -> dict:
    """E1: retail + wholesale sales, aligned and combined; raises if retail rows were lost or repeated."""
    other = None
    if combined:
        other = wholesale.sales_table(wholesale.labelled_sales(tables(spark, sf).wholesale_sales, WHO))
        other = retail.with_status(other, report.is_matched(blank="matched"))
    gated = written(gated_sales(spark, sf), "gated-sales")
    return _run(gated, sales_key_results(spark, sf, gated), SAL, retail.sales_matched_mask, lambda d: d, other, combine.SALES_OUTPUT, "sales")


def inventory_run(spark: SparkSession, sf: str, combined: bool = True) -> dict:
    """E2: retail + wholesale inventory snapshots, aligned and combined; raises if retail rows were lost or repeated."""
    other = None
    if combined:
        other = retail.with_status(wholesale.labelled_inventory(tables(spark, sf).wholesale_inventory, WHO), report.is_matched())
    gated = written(gated_inventory(spark, sf), "gated-inventory")
    return _run(gated, inventory_key_results(spark, sf, gated), INV, retail.inventory_matched_mask, retail.inventory_quantity, other,
                combine.INVENTORY_OUTPUT, "inventory")


# The original's table names.
SALES_TABLES = {"matched": "matched_sales_with_snop_category", "unmatched": "unmatched_sales_without_snop_category"}
INVENTORY_TABLES = {"matched": "matched_inventory_with_snop_category", "unmatched": "unmatched_inventory_without_snop_category"}


def load_sales(run: dict, base: str, start) -> None:
    """Reloads both sales tables from ``start`` on."""
    for status, name in SALES_TABLES.items():
        window_reload(run[status], f"{base}/{name}", "TRANSACTIONDATE", start)


def load_inventory(run: dict, base: str) -> None:
    """Reloads the snapshot dates of both inventory tables."""
    for status, name in INVENTORY_TABLES.items():
        snapshot_reload(run[status], f"{base}/{name}", "INVENTORYDATE")


def _tables_read(spark: SparkSession, base: str, names: dict) -> DataFrame:
    frames = [read_table(spark, f"{base}/{name}").withColumn("STATUS", F.lit(status)) for status, name in names.items()]
    return frames[0].unionByName(frames[1])


def _shifted(df: DataFrame, date_col: str, days: int) -> DataFrame:
    """An older load: the same rows some days off, with twice the quantity."""
    return df.withColumns({date_col: F.date_add(F.col(date_col), days), "TOTAL_QUANTITY": F.col("TOTAL_QUANTITY") * 2})


def reload_sales(spark: SparkSession, sf: str, days: int = 90) -> DataFrame:
    """Both sales tables after a reload of the trailing window over an older load, run twice.

    The older load has dates before the window (which stay), in it (replaced) and behind its end (which vanish).
    """
    base = f"{checkpoint_dir(spark).rstrip('/')}/reload-{uuid.uuid4().hex}"
    run = sales_run(spark, sf)
    both = run["matched"].unionByName(run["unmatched"])
    # the window ends with the run's last day; the channels' own windows begin no earlier than its first
    first, end = both.agg(F.min("TRANSACTIONDATE"), F.max("TRANSACTIONDATE")).first()
    start = min(first, end - _dt.timedelta(days=days))
    older = {s: _shifted(run[s], "TRANSACTIONDATE", -45).unionByName(_shifted(run[s], "TRANSACTIONDATE", 4000)) for s in SALES_TABLES}
    load_sales(older, base, start - _dt.timedelta(days=45))
    for _ in range(2):
        load_sales(run, base, start)
    return _tables_read(spark, base, SALES_TABLES)


def reload_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Both inventory tables after a reload of the snapshot over an older load of it and of the day before, run twice."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/reload-{uuid.uuid4().hex}"
    run = inventory_run(spark, sf)
    load_inventory({s: _shifted(run[s], "INVENTORYDATE", 0).unionByName(_shifted(run[s], "INVENTORYDATE", -1)) for s in INVENTORY_TABLES}, base)
    for _ in range(2):
        load_inventory(run, base)
    return _tables_read(spark, base, INVENTORY_TABLES)


def combined_controls(spark: SparkSession, sf: str) -> DataFrame:
    """Control totals of the four combined tables, counted while they were written."""
    rows = report.controls_rows({"sales": sales_run(spark, sf)["controls"], "inventory": inventory_run(spark, sf)["controls"]})
    return spark.createDataFrame(rows, "TABLE_NAME string, STATUS string, ROWS long, QUANTITY_BEFORE double, NULLS_BEFORE long, QUANTITY_AFTER double, NULLS_AFTER long")


def accounting(spark: SparkSession, sf: str) -> DataFrame:
    """Row accounting of both retail runs, counted while they were written."""
    rows = [{**run(spark, sf, combined=False)["accounting"], "CHANNEL": name} for name, run in (("retail_sales", sales_run), ("retail_inventory", inventory_run))]
    return spark.createDataFrame(rows, "INPUT_ROWS long, SOURCE_ROWS long, MATCHED_ROWS long, UNMATCHED_CORE_ROWS long, WRONG_BRAND_ROWS long, BALANCED boolean, CHANNEL string")


def wholesale_exports(spark: SparkSession, sf: str) -> DataFrame:
    """The wholesale run's CSV files (sales, summaries, inventory), read back: rows and totals of each file."""
    t = tables(spark, sf)
    # both extracts are made once: six files are written from them
    sales = written(wholesale.labelled_sales(t.wholesale_sales, WHO), "wholesale-sales")
    matched, unmatched = wholesale.split_sales(sales)
    stock = written(wholesale.labelled_inventory(t.wholesale_inventory, WHO), "wholesale-inventory")
    has = report.is_matched(blank="matched")
    frames = {"matched_sales_with_snop_category": matched, "unmatched_sales_without_snop_category": unmatched,
              "matched_category_summary": wholesale.sales_category_summary(sales, WHO), "daily_category_summary": wholesale.sales_daily_summary(sales),
              "matched_wholesale_inventory": stock.filter(has), "unmatched_wholesale_inventory": stock.filter(~has)}
    root = export_csv(frames, f"{checkpoint_dir(spark).rstrip('/')}/exports-{uuid.uuid4().hex}")
    out = None
    for name, df in frames.items():
        back = read_csv_export(spark, root, name, df.schema)
        qty = "TOTAL_QUANTITY" if "TOTAL_QUANTITY" in back.columns else "UNIT_COUNT"
        revenue = F.sum("TOTAL_REVENUE") if "TOTAL_REVENUE" in back.columns else F.lit(None).cast("double")
        own = back.agg(F.count(F.lit(1)).alias("ROWS"), F.sum(qty).alias("QUANTITY"), revenue.alias("REVENUE"),
                       F.count("PRODUCTNAME" if "PRODUCTNAME" in back.columns else "TRANSACTIONDATE").alias("NAMED"))
        own = own.select(F.lit(name).alias("FILE"), "*")
        out = own if out is None else out.unionByName(own)
    return out
