"""Veto rules and unit conversions on small in-memory frames (hand-computed)."""

import pytest
from pyspark.sql import functions as F

from planmatch.config import FIXTURE_INVENTORY as INV
from planmatch.config import FIXTURE_SALES as SAL
from planmatch.config import FIXTURE_WHOLESALE as WHO
from dataclasses import replace
from planmatch.functions.units import inventory_unit_count, sales_unit_count
from planmatch.operators import rules as R

PAIR = ("NAME_LC string, BRANDNAME string, P_TYPE string, P_GRAMS double, P_STRAIN string, P_PACK string, "
        "P_FLAVORS array<string>, P_FLAVOR_STR string, REF_CAT string, REF_GRAMS double, REF_PACK string, "
        "REF_FLAVORS array<string>, REF_FLAVOR_STR string")


def pair(spark, **kw):
    base = dict(NAME_LC="x", BRANDNAME="Brand#9", P_TYPE="flower", P_GRAMS=3.5, P_STRAIN=None, P_PACK=None,
                P_FLAVORS=[], P_FLAVOR_STR="", REF_CAT="Brand#9 Flower", REF_GRAMS=3.5, REF_PACK=None,
                REF_FLAVORS=["x"], REF_FLAVOR_STR="")
    base.update(kw)
    cols = [c.split()[0] for c in PAIR.split(", ")]
    return spark.createDataFrame([tuple(base[c] for c in cols)], PAIR)


def ev(df, col):
    return df.select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("pg,mg,expected_reject,expected_skip", [
    (28.0, 3.5, False, False), (3.5, 3.54, True, True), (1.05, 1.0, False, False),
    (None, 3.5, False, True), (0.0, 3.5, True, True),
])
def test_grams_check(spark, pg, mg, expected_reject, expected_skip):
    df = pair(spark, P_GRAMS=pg, REF_GRAMS=mg)
    assert ev(df, R.grams_check(SAL)) is expected_reject
    assert ev(df, R.grams_check(replace(SAL, missing_grams="skip"))) is expected_skip


def test_grams_check_only_for_weighted_types(spark):
    assert ev(pair(spark, P_TYPE="edible", P_GRAMS=28.0, REF_GRAMS=3.5), R.grams_check(SAL)) is True
    assert ev(pair(spark, P_TYPE=None, P_GRAMS=None), R.grams_check(SAL)) is True


def test_strain_strict_unknown(spark):
    df = pair(spark, P_STRAIN="indica", REF_CAT="Brand#9 Flower")
    assert ev(df, R.strain_strict_lock(SAL)) is False
    assert ev(df, R.strain_strict_lock(INV)) is True


def test_strain_check(spark):
    assert ev(pair(spark, P_STRAIN="indica", REF_CAT="Sativa Flower"), R.strain_check()) is False
    assert ev(pair(spark, P_STRAIN=None, REF_CAT="Sativa Flower"), R.strain_check()) is True


def test_pr_lock(spark):
    assert ev(pair(spark, NAME_LC="x preroll", REF_CAT="Brand#2 Vape"), R.pr_lock(SAL)) is False
    assert ev(pair(spark, NAME_LC="x flower", REF_CAT="Brand#2 Preroll"), R.pr_lock(INV)) is False
    assert ev(pair(spark, NAME_LC="x flower", REF_CAT="Brand#2 Preroll"), R.pr_lock(SAL)) is True


def test_packaging_lock(spark):
    assert ev(pair(spark, NAME_LC="a preroll (5pk)", P_PACK="5", REF_PACK=None), R.packaging_lock()) is False
    assert ev(pair(spark, NAME_LC="a preroll", P_PACK=None, REF_PACK=None), R.packaging_lock()) is True
    assert ev(pair(spark, NAME_LC="a flower", P_PACK="5", REF_PACK=None), R.packaging_lock()) is True


def test_brand_lock(spark):
    assert ev(pair(spark, BRANDNAME="Brand#2", REF_CAT="Brand#9 Flower"), R.brand_category_lock(SAL)) is False
    assert ev(pair(spark, BRANDNAME="Brand#2", REF_CAT="Brand#9 Flower"), R.brand_category_lock(INV)) is True
    assert ev(pair(spark, BRANDNAME="Brand#4", REF_CAT="Brand#9 Flower"), R.brand_category_lock(INV)) is False
    assert ev(pair(spark, BRANDNAME="", REF_CAT="x"), R.brand_category_lock(SAL)) is True
    assert ev(pair(spark, BRANDNAME="Brand#2", REF_CAT=None), R.brand_category_lock(SAL)) is True


def test_infused_and_preground(spark):
    assert ev(pair(spark, NAME_LC="a infused", REF_CAT="b"), R.infused_lock()) is False
    assert ev(pair(spark, NAME_LC="a 17g", REF_CAT="b preroll"), R.preground_lock(SAL)) is False


def test_flavor_check(spark):
    df = pair(spark, P_TYPE="edible", P_FLAVORS=["berry", "lime"], REF_FLAVORS=["lime", "berry", "x"])
    assert ev(df, R.edible_flavor_check(SAL)) is True
    df = pair(spark, P_TYPE="edible", P_FLAVORS=["berry"], REF_FLAVORS=[])
    assert ev(df, R.edible_flavor_check(SAL)) is False
    df = pair(spark, P_TYPE="edible", P_FLAVORS=["berry"], P_FLAVOR_STR="berry", REF_FLAVORS=["berry"],
              REF_FLAVOR_STR="berry")
    assert ev(df, R.edible_flavor_check(SAL)) is True


def test_failed_checks_report(spark):
    df = pair(spark, NAME_LC="x infused", P_GRAMS=28.0, REF_GRAMS=3.5, P_STRAIN="indica", REF_CAT="Sativa Flower")
    assert ev(df, R.failed_checks(INV)) == "infused_lock,strain_check,strain_strict_lock,grams_check"


def test_sales_units(spark):
    rows = [("Grams", "X BULK", 2.0, 10), ("Grams", "X", 2.0, 10), ("Units", "X", 2.0, 10),
            ("Case", "X", 2.0, 10), ("Case", "X", None, 10), ("Case", "X", 2.0, None), (None, "x trim", 2.0, 3)]
    df = spark.createDataFrame(rows, "WEIGHTUNIT string, PRODUCTNAME string, QUANTITY double, UNITSPERCASE int")
    got = [r[0] for r in df.select(sales_unit_count(WHO)).collect()]
    assert got == [907.2, 2.0, 2.0, 20.0, 0.0, 2.0, 6.0]


def test_inventory_units(spark):
    rows = [("X BULK", 2.0, 10), ("X", 2.0, 0), ("X", 2.0, 10), ("X", None, 10), ("x Trim", 1.0, None)]
    df = spark.createDataFrame(rows, "PRODUCTNAME string, QUANTITYONHAND double, UNITSPERCASE int")
    got = [r[0] for r in df.select(inventory_unit_count(WHO)).collect()]
    assert got == [907.2, 2.0, 20.0, 0.0, 453.6]
