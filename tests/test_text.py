"""Hand-written cases for the text features (expected values worked out by hand)."""

import pytest
from pyspark.sql import functions as F

from planmatch.config import FIXTURE_INVENTORY as INV
from planmatch.config import FIXTURE_SALES as SAL
from planmatch.functions import text as TX


def one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "n string")
    return df.select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("value,expected", [
    ("Gummies 100mg (10pk)", 0.1), ("Flower 3.5g", 3.5), ("7 g", None), (None, None),
    ("x 1.5.5g", 5.5), ("28G bulk", 28.0), ("50mg", 0.05),
])
def test_extract_grams(spark, value, expected):
    assert one(spark, value, TX.extract_grams(F.col("n"))) == expected


def test_clean_text(spark):
    assert one(spark, "AU:Red MED: X ", TX.clean_text("n")) == "red  x"
    assert one(spark, None, TX.clean_text("n")) == ""
    assert one(spark, "  Tab\t", TX.clean_text("n")) == "tab"


def test_normalize_text(spark):
    assert one(spark, "Café – X", TX.normalize_text(F.col("n"))) == "cafe x"
    assert one(spark, "plain  ascii ", TX.normalize_text(F.col("n"))) == "plain ascii"
    assert one(spark, "rÃ³d", TX.normalize_text(F.col("n"))) == "ra3d"


def test_flavor_tokens_substring_removal(spark):
    # 'oliver' loses 'live' -> 'or', too short
    assert one(spark, "Oliver Berry Gummies", TX.flavor_tokens("n", SAL)) == ["berry"]
    assert one(spark, "Oliver Berry Gummies", TX.flavor_string("n", SAL)) == "or berry"


def test_flavor_order_differs_between_presets(spark):
    # inventory strips '-' first, so 'pre-roll' becomes 'preroll' and is removed
    assert one(spark, "Mango Pre-Roll", TX.flavor_tokens("n", INV)) == ["mango"]
    assert one(spark, "Mango Pre-Roll", TX.flavor_tokens("n", SAL)) == ["mango"]
    assert one(spark, "Kiwi Pre-Rolls", TX.flavor_tokens("n", SAL)) == ["kiwi"]
    assert one(spark, "Kiwi Pre-Rolls", TX.flavor_tokens("n", INV)) == ["kiwi"]


def test_strain_priority(spark):
    assert one(spark, "Sativa Hybrid", TX.strain("n")) == "hybrid"
    assert one(spark, None, TX.strain("n")) is None


def test_product_type_presets(spark):
    assert one(spark, "Live Resin Vape", TX.product_type(F.col("n"), SAL)) == "vape"
    assert one(spark, "Live Resin Vape", TX.product_type(F.col("n"), INV)) == "concentrate"
    assert one(spark, "Blue Dream 3.5g", TX.product_type(F.col("n"), INV)) == "flower"
    assert one(spark, "Blue Dream 3.5gx", TX.product_type(F.col("n"), INV)) is None
    assert one(spark, "Bulk Trim", TX.product_type(F.col("n"), INV)) == "flower"
    assert one(spark, "Bulk Trim", TX.product_type(F.col("n"), SAL)) is None


def test_pack_and_token_key(spark):
    assert one(spark, "X Preroll (5pk)", TX.pack_size("n")) == "5"
    assert one(spark, "X Preroll", TX.pack_size("n")) is None
    assert one(spark, "b a  c", TX.token_sort_key(F.col("n"))) == "a b c"
