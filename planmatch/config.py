"""Rule sets: every vocabulary, threshold and behavioural switch of the matcher.

Two presets carry the differences between the sales and the inventory matcher
(brand gate case, word-removal order, product-type ladder, veto rules, exact-key
normalisation, overrides).  ``fixture_sales`` / ``fixture_inventory`` are the
same behaviour with the vocabulary of the driver-derived test tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# These must equal the original job's lists for identical
# results.  Order matters where noted (substring removal and type detection
# are applied in list order).
# ---------------------------------------------------------------------------

# Removed (as substrings, in this order) before flavour tokens are taken.
FLAVOR_STOP_WORDS = (
    "gummy", "gummies", "chocolate", "hybrid", "indica", "sativa", "dab", "fx",
    "nano", "rso", "cannatini", "edible", "infused", "distillate", "smalls",
    "tops", "live", "concentrate", "sauce", "wax", "preroll", "pre-roll",
)

# Product-type vocabularies.
FLOWER_WORDS_SALES = ("flower", "pre-roll", "preroll", "smalls", "tops")
FLOWER_WORDS_INVENTORY = ("flower", "smalls", "tops", "bulk")
PREROLL_WORDS = ("preroll", "pre-roll")
VAPE_WORDS = ("vape", "cartridge")
CONCENTRATE_WORDS = ("shatter", "wax", "crumble", "batter", "sugar", "live", "resin", "rosin", "sauce")
EDIBLE_WORDS = ("gummies", "chocolate", "drink", "edible", "capsule", "syrup")

# Strain words, checked in this order (first hit wins).
STRAIN_WORDS = ("hybrid", "indica", "sativa")

# Name prefixes removed by the clean-up (case-sensitive, anywhere in the text).
NAME_PREFIXES = ("AU:", "MED:")

# Types for which the weight check applies.
GRAMS_CHECK_TYPES = ("flower", "concentrate", "vape", "preroll")

# Preground lock trigger words.
PREGROUND_WORDS = ("preground", "7g", "bulk", "ounce")

# Approved brands of the production job ('' = no brand, approved).
APPROVED_BRANDS = (
    "NEA Fire", "NEA Premium", "NEA Awarded", "Sapura", "Cannatini", "Valorem",
    "Dab FX", "Double Baked", "Farm To Fam", "SWEETSPOT", "Dab FX+",
    "Northeast Alternatives", "Higher Celebrations", "NEA Pride Jays", "",
)

# Brand -> keywords of which at least one must appear in the matched category.
BRAND_LOCKS_SALES = (
    ("nea fire", ("nea fire",)),
    ("nea awarded", ("nea awarded",)),
    ("nea premium", ("nea premium",)),
    ("valorem", ("valorem",)),
)
BRAND_LOCKS_INVENTORY = (
    ("nea fire", ("nea fire", "nea")),
    ("valorem", ("valorem",)),
    ("nea premium", ("nea",)),
    ("nea awarded", ("nea",)),
)

MASTER_CATEGORIES = ("NEA Flower", "NEA MIPs")

# Wholesale buyers that are internal transfers (compared lower-case).
EXCLUDED_BUYERS = (
    "northeast alternatives - fall river",
    "near / northeast alternatives retail, llc - seekonk",
    "near / northeast alternatives retail, llc - new bedford",
)

# Bulk / trim override categories and the premium keyword.
BULK_PREMIUM_KEYWORD = "nea fire"
BULK_PREMIUM_CATEGORY = "NEA Fire Bulk Flower g"
BULK_DEFAULT_CATEGORY = "NEA Bulk Flower g"

POUND_IN_GRAMS = 453.6

# Result labels.
LABEL_WRONG_BRAND = "Wrong Brand"
LABEL_EXACT = "Matched (Exact Match)"
LABEL_EXACT_BRAND = "Matched (Exact Match w/ Brand)"
LABEL_EXCEPTION = "Matched (Exact Match – Name Exception)"
LABEL_HIGH_CONFIDENCE = "High-Confidence Override"
LABEL_STRICT = "Matched (Strict Rules)"
LABEL_BACKUP = "Backup S&OP Match"
LABEL_FALLBACK = "Fallback Preroll Match"
LABEL_BULK = "Bulk Override"
LABEL_TRIM = "Trim Override"
LABEL_NO_MATCH = "No Acceptable Match"
LABEL_WHOLESALE = "Matched (wholesale clean)"
LABEL_MISSING_SKU = "Missing SKU"
REF_WHOLESALE = "wholesale direct"

# Mojibake repairs tried for exact lookups, in this order.
MOJIBAKE_PAIRS = (
    ("Ã©", "é"), ("ã©", "é"),
    ("Ã±", "ñ"), ("ã±", "ñ"),
    ("Ã¼", "ü"), ("ã¼", "ü"),
)


@dataclass(frozen=True)
class RuleSet:
    """All knobs of one matcher preset."""

    name: str
    master_categories: tuple = MASTER_CATEGORIES
    approved_brands: tuple = APPROVED_BRANDS
    # brand gate: strip + lower-case comparison (sales) or exact (inventory)
    gate_case_insensitive: bool = True
    name_prefixes: tuple = NAME_PREFIXES
    stop_words: tuple = FLAVOR_STOP_WORDS
    # inventory strips non-letters before removing stop words, sales after
    strip_nonletters_first: bool = False
    # 'sales' or 'inventory' product-type ladder
    type_ladder: str = "sales"
    # inventory: CATEGORY containing this word, or MASTERCATEGORY equal to
    # ``type_override_master`` (lower-case), forces type 'concentrate'
    type_override_word: str | None = None
    type_override_master: str | None = None
    # exact lookups on the raw name (sales) or the normalised name (inventory)
    normalized_keys: bool = False
    name_exceptions: bool = False
    high_confidence: bool = False
    # thresholds
    strict_threshold: float = 75.0
    partial_threshold: float = 70.0
    flavor_threshold: float = 85.0
    top_k: int = 5
    # 'reject' = what the original does with a missing weight, 'skip' = its comment
    missing_grams: str = "reject"
    grams_types: tuple = GRAMS_CHECK_TYPES
    preground_words: tuple = PREGROUND_WORDS
    # 'sales': name contains 'pr' => category must not be concentrate/vape;
    # 'inventory': category contains preroll => name must too
    pr_lock: str = "sales"
    strain_strict_unknown_passes: bool = False
    brand_locks: tuple = BRAND_LOCKS_SALES
    type_conflict_lock: bool = False
    packaging_lock: bool = False
    # catalog column holding the brand for the preroll fallback (None => '')
    catalog_brand_col: str | None = "Brand"
    # sales: a failed preroll fallback replaces the previous result label
    fallback_overwrites: bool = True
    # bulk override
    bulk_premium_keyword: str = BULK_PREMIUM_KEYWORD
    bulk_premium_category: str = BULK_PREMIUM_CATEGORY
    bulk_default_category: str = BULK_DEFAULT_CATEGORY
    bulk_brand_or_name: bool = True
    bulk_premium_score: float = 100.0
    bulk_default_score: float = 95.0
    # sales: '' category also counts as missing for the override
    bulk_blank_is_missing: bool = True
    diagnostics: bool = False
    extra: dict = field(default_factory=dict)


SALES = RuleSet(name="sales")

INVENTORY = RuleSet(
    name="inventory",
    gate_case_insensitive=False,
    strip_nonletters_first=True,
    type_ladder="inventory",
    type_override_word="concentrate",
    type_override_master="nea mips",
    normalized_keys=True,
    name_exceptions=True,
    high_confidence=True,
    pr_lock="inventory",
    strain_strict_unknown_passes=True,
    brand_locks=BRAND_LOCKS_INVENTORY,
    type_conflict_lock=True,
    packaging_lock=True,
    fallback_overwrites=False,
    bulk_brand_or_name=False,
    bulk_blank_is_missing=False,
    diagnostics=True,
)


@dataclass(frozen=True)
class WholesaleRules:
    """Wholesale extract, unit conversion and override vocabulary."""

    excluded_buyers: tuple = EXCLUDED_BUYERS
    pound_in_grams: float = POUND_IN_GRAMS
    trim_word: str = "TRIM"
    bulk_word: str = "BULK"
    bulk_words: tuple = ("BULK", "TRIM")
    grams_unit: str = "Grams"
    unit_units: tuple = ("Units", "Unit")
    premium_keyword: str = "NEA FIRE"
    premium_category: str = BULK_PREMIUM_CATEGORY
    default_category: str = BULK_DEFAULT_CATEGORY
    location: str = "Wholesale"


WHOLESALE = WholesaleRules()

# ---------------------------------------------------------------------------
# Vocabulary of the driver-derived fixture tables (see FIXTURES.md).
# ---------------------------------------------------------------------------

FIXTURE_BRANDS = tuple(f"Brand#{i}" for i in range(1, 21)) + ("",)
FIXTURE_MASTER = ("Flower", "MIPs")
FIXTURE_BUYERS = ("supplier#000000001", "supplier#000000002", "supplier#000000003")

FIXTURE_SALES = replace(
    SALES,
    name="fixture_sales",
    master_categories=FIXTURE_MASTER,
    approved_brands=FIXTURE_BRANDS,
    brand_locks=tuple((f"brand#{i}", (f"brand#{i}",)) for i in range(1, 5)),
    catalog_brand_col="BRAND",
    bulk_premium_keyword="brand#1",
)

FIXTURE_INVENTORY = replace(
    INVENTORY,
    name="fixture_inventory",
    master_categories=FIXTURE_MASTER,
    approved_brands=FIXTURE_BRANDS,
    brand_locks=tuple((f"brand#{i}", ("brand#",)) for i in range(1, 4)) + (("brand#4", ("brand#4",)),),
    type_override_master="mips",
    catalog_brand_col="BRAND",
    bulk_premium_keyword="brand#1",
)

FIXTURE_WHOLESALE = replace(
    WHOLESALE,
    excluded_buyers=FIXTURE_BUYERS,
    premium_keyword="BRAND#1",
)
