"""Every registered query runs on the smallest driver tables; those with an
oracle agree with DuckDB (row count, columns, order-insensitive values);
row accounting balances."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from planmatch.operators import ladder as L
from planmatch.operators import report
from planmatch.plans import pipelines as P
from planmatch.queries import QUERIES
from planmatch.sources import fixtures
from planmatch.sources.fixtures import tables
from planmatch.sql.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for _, r in pdf.iterrows()), key=repr)


@pytest.fixture
def con():
    """A connection for each test: one that fails takes no other with it."""
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_agrees(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).fetchdf()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_catalog_is_built_from_every_part(spark, con):
    names = [r[0] for r in tables(spark, SF)["catalog"].select("PRODUCTNAME").collect()]
    parts = con.execute("SELECT p_partkey, p_name FROM part").fetchall()
    assert len(parts) > 0
    for key, name in parts:
        name = name.replace("o", "ó") if key % 60 == 0 else name
        assert any(n.startswith(name + " ") for n in names), key


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_row_accounting_balances(spark):
    for r in E.queries()["row_accounting"](spark, SF).collect():
        assert r["BALANCED"], r.asDict()


def test_row_accounting_sees_lost_and_repeated_rows(spark):
    out = P.retail_sales_outputs(spark, SF)
    unmatched = out["unmatched"]
    assert unmatched.count() > 1
    for wrong in (unmatched.unionAll(unmatched), unmatched.limit(1)):
        row = report.row_accounting(out["gated"], out["matched"], wrong).first()
        assert not row["BALANCED"]
        with pytest.raises(AssertionError):
            report.assert_balanced(row)


def test_run_raises_when_the_join_repeats_rows(spark):
    """Counted in flight, after the write: key results with a key twice."""
    gated, results = P.gated_sales(spark, SF), P.sales_key_results(spark, SF)
    good = P._run(gated, results, P.SAL, P.retail.sales_matched_mask, lambda d: d, None, [], "good")
    assert good["accounting"]["BALANCED"] and good["accounting"]["INPUT_ROWS"] == gated.count() == good["matched"].count() + good["unmatched"].count()
    assert results.count() > 0
    with pytest.raises(AssertionError, match="row accounting"):
        P._run(gated, results.unionAll(results), P.SAL, P.retail.sales_matched_mask, lambda d: d, None, [], "bad")


def test_run_scans_its_source_once(spark):
    """Extract, labels, split, accounting and controls of a run: one write reads each source table once."""
    plans = []
    write = type(spark.range(1).write).parquet

    def kept(self, path, *args, **kwargs):
        if "run-sales" in path:
            plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, path, *args, **kwargs)

    type(spark.range(1).write).parquet = kept
    try:
        P.sales_run(spark, SF)
    finally:
        type(spark.range(1).write).parquet = write
    assert len(plans) == 1
    assert plans[0].count("l_returnflag") and plans[0].count("CollectMetrics") == 3
    retail_scans = [line for line in plans[0].splitlines() if "Relation" in line and "l_returnflag" in line]
    assert len(retail_scans) <= 2  # retail, and wholesale's own scan of the same table


@pytest.mark.parametrize("name, column", [("retail_extract", "l_shipdate"), ("wholesale_extract", "l_shipdate"), ("retail_latest_snapshot", "ts"), ("wholesale_latest_snapshot", "ts")])
def test_date_bounds_reach_the_scan(spark, name, column):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [line.split("PushedFilters: [")[1].split("], ReadSchema")[0] for line in plan.splitlines() if "PushedFilters: [" in line and f"{column}:timestamp" in line]
    assert pushed and all(f"GreaterThanOrEqual({column}" in p and f"LessThan({column}" in p for p in pushed)


def test_matched_layout_has_the_source_columns_only(spark):
    columns = P.retail_sales_outputs(spark, SF)["matched"].columns
    assert "PRODUCTTYPE" not in columns
    assert {"PRODUCTID", "PRODUCTGRAMS", "BRANDNAME"} <= set(columns)


def test_entry(spark):
    df = E.entry(spark)
    assert set(df.columns) >= {"LOCATIONNAME", "TRANSACTIONDATE", "MATCHED_SNOP_CATEGORY"}
    assert df.count() > 0


def test_edible_backup_runs_over_all_edible_keys(spark):
    """Not only over those of the run that the tiers before it leave open."""
    sales, rules = tables(spark, SF).retail_sales, P.SAL
    gated = P.retail.brand_gate(sales.filter(sales.MASTERCATEGORY.isin(list(rules.master_categories))), rules).filter("APPROVED")
    feats = L.product_features(L.product_keys(gated, rules), rules)
    best = L.backup_tier(feats, L.Catalog(tables(spark, SF).catalog, rules).categories, rules)
    want = {(r.PRODUCTNAME, r.BRANDNAME) for r in best.collect()}
    assert len(want) > 1
    assert {(r.PRODUCTNAME, r.BRANDNAME) for r in QUERIES["edible_backup"](spark, SF).collect()} == want


def test_large_sides_are_shuffled(spark, monkeypatch):
    """Sides that are not proven small do not pass through the driver; the rows are the same."""
    small = {n: tables(spark, SF)[n] for n in ("wholesale_sales", "wholesale_inventory", "retail_inventory")}
    monkeypatch.setattr(fixtures, "DEFAULT_BROADCAST_BYTES", 0)
    monkeypatch.setattr(fixtures, "PART_BYTES", 1000)
    for name, df in small.items():
        large = tables(spark, SF)[name]
        assert "Join" in (plan := large._jdf.queryExecution().optimizedPlan().toString())
        assert plan.count("rightHint=(strategy=merge)") >= 1
        assert large.count() == df.count() > 0
        assert large.exceptAll(df).isEmpty() and df.exceptAll(large).isEmpty()


def test_exports_make_each_extract_once(spark, monkeypatch):
    """Six files come from two extracts that are written before: no file's plan joins the lines again."""
    plans = []
    export = P.export_csv

    def kept(frames, *args):
        plans.extend(df._jdf.queryExecution().optimizedPlan().toString() for df in frames.values())
        return export(frames, *args)

    monkeypatch.setattr(P, "export_csv", kept)
    assert P.wholesale_exports(spark, SF).count() == 6
    assert len(plans) == 6 and not any("Join" in p for p in plans)


def test_run_makes_its_extract_and_the_catalog_once(spark, monkeypatch):
    """Keys and rows of a run come from one extract, a preset's derivations from one catalog: each is written before."""
    made = []
    write = L.written

    def kept(df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        made.append((name, "l_returnflag" in plan, "p_partkey" in plan))
        return write(df, name)

    for module in (L, P, P.retail):
        monkeypatch.setattr(module, "written", kept)
    P.sales_run(spark, SF, combined=False)
    assert [n for n, sales, _ in made if sales] == ["gated-sales"]
    assert [n for n, _, part in made if part] == ["gated-sales", "catalog-rows"]
