"""Text features as native Spark Column expressions (whole-stage codegen).

Python-string semantics that differ from Spark defaults are handled here:
``str.strip()``/``str.split()`` use Unicode whitespace (``WS``), substring
removal is a fold of ``replace`` in list order, null names behave as ''.
Only NFKD folding needs Python (see ``similarity.nfkd_ascii``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from planmatch.config import (
    CONCENTRATE_WORDS,
    EDIBLE_WORDS,
    FLOWER_WORDS_INVENTORY,
    FLOWER_WORDS_SALES,
    PREROLL_WORDS,
    STRAIN_WORDS,
    VAPE_WORDS,
    RuleSet,
)

# Python's str.isspace() set: Unicode White_Space plus the ASCII separators 0x1c-0x1f.
WS = r"[\s\x1c-\x1f]"
_STRIP = r"(?U)^" + WS + r"+|" + WS + r"+$"
GRAMS_PATTERN = r"(\d+\.?\d*)(g|mg)"
PACK_PATTERN = r"\((\d+)pk\)"
WEIGHT_WORD_PATTERN = r"(?U)\b(\d+(\.\d+)?g)\b"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.regexp_replace(col_(c), _STRIP, "")


def str_or_empty(c) -> Column:
    return F.coalesce(col_(c), F.lit(""))


def contains_any(text: Column, words) -> Column:
    """Any of the words as a substring; one literal alternation keeps generated code small."""
    words = list(words)
    if len(words) <= 2:
        return reduce(lambda a, b: a | b, [text.contains(w) for w in words])
    return text.rlike("|".join(_java_quote(w) for w in words))


def _java_quote(w: str) -> str:
    return "\\Q" + w.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def remove_all(text: Column, words) -> Column:
    """Sequential substring removal, order preserved (not one alternation)."""
    return reduce(lambda acc, w: F.replace(acc, F.lit(w), F.lit("")), words, text)


def clean_text(c, rules: RuleSet | None = None) -> Column:
    """Remove name prefixes anywhere, strip, lower-case; null -> ''."""
    prefixes = rules.name_prefixes if rules is not None else ("AU:", "MED:")
    return F.lower(strip_ws(remove_all(str_or_empty(c), prefixes)))


def collapse_ws(c) -> Column:
    return F.regexp_replace(col_(c), "(?U)" + WS + "+", " ")


def normalize_text(c) -> Column:
    """NFKD fold to ASCII, collapse whitespace, strip, lower-case; null -> ''.

    Pure-ASCII strings (the common case) never leave the JVM; others go
    through the Arrow NFKD helper.
    """
    from planmatch.functions.similarity import nfkd_ascii

    s = str_or_empty(c)
    is_ascii = s.rlike(r"^[\x00-\x7F]*$")
    folded = F.coalesce(nfkd_ascii(F.when(~is_ascii, s)), s)
    return F.lower(strip_ws(collapse_ws(folded)))


def match_key(c, rules: RuleSet) -> Column:
    """Product-side fuzzy key: cleaned (sales) or cleaned + normalised (inventory)."""
    cleaned = clean_text(c, rules)
    return normalize_text(cleaned) if rules.normalized_keys else cleaned


def reference_key(c, rules: RuleSet) -> Column:
    """Catalog-side name key: lower-cased (sales) or cleaned + normalised (inventory)."""
    if rules.normalized_keys:
        return normalize_text(clean_text(c, rules))
    return F.lower(col_(c))


def extract_grams(c) -> Column:
    """First ``number(g|mg)`` in the lower-cased text; mg -> g rounded to 4 places."""
    lowered = F.lower(col_(c))
    value = F.regexp_extract(lowered, GRAMS_PATTERN, 1).try_cast("double")
    unit = F.regexp_extract(lowered, GRAMS_PATTERN, 2)
    return F.when(unit == "g", value).when(unit == "mg", F.round(value / 1000.0, 4))


def pack_size(c) -> Column:
    """``(Npk)`` digits as written (string); null when absent."""
    s = F.regexp_extract(F.lower(col_(c)), PACK_PATTERN, 1)
    return F.when(s != "", s)


def pack_number(c) -> Column:
    return pack_size(c).try_cast("decimal(38,0)")


def flavor_text(c, rules: RuleSet) -> Column:
    lowered = F.lower(str_or_empty(c))
    letters = "(?U)[^a-zA-Z" + WS[1:-1] + "]"
    if rules.strip_nonletters_first:
        return remove_all(F.regexp_replace(lowered, letters, ""), rules.stop_words)
    return F.regexp_replace(remove_all(lowered, rules.stop_words), letters, "")


def flavor_tokens(c, rules: RuleSet) -> Column:
    """Words of at least 3 letters left after stop-word removal."""
    parts = F.split(flavor_text(c, rules), "(?U)" + WS + "+")
    return F.filter(parts, lambda w: F.length(w) >= 3)


def flavor_string(c, rules: RuleSet) -> Column:
    return strip_ws(flavor_text(c, rules))


def strain(c) -> Column:
    t = F.lower(str_or_empty(c))
    out = F.lit(None).cast("string")
    for w in reversed(STRAIN_WORDS):
        out = F.when(t.contains(w), F.lit(w)).otherwise(out)
    return out


def product_type(c, rules: RuleSet) -> Column:
    t = F.lower(col_(c))
    if rules.type_ladder == "sales":
        return (
            F.when(contains_any(t, FLOWER_WORDS_SALES), "flower")
            .when(contains_any(t, VAPE_WORDS), "vape")
            .when(contains_any(t, CONCENTRATE_WORDS), "concentrate")
            .when(contains_any(t, EDIBLE_WORDS), "edible")
        )
    return (
        F.when(contains_any(t, CONCENTRATE_WORDS), "concentrate")
        .when(contains_any(t, EDIBLE_WORDS), "edible")
        .when(contains_any(t, PREROLL_WORDS), "flower")
        .when(t.rlike(WEIGHT_WORD_PATTERN), "flower")
        .when(contains_any(t, FLOWER_WORDS_INVENTORY), "flower")
        .when(contains_any(t, VAPE_WORDS), "vape")
    )


def product_type_with_override(name, category, master, rules: RuleSet) -> Column:
    """Inventory: CATEGORY containing the word or the master category forces 'concentrate'."""
    base = product_type(name, rules)
    if rules.type_override_word is None:
        return base
    cat = F.lower(F.coalesce(col_(category), F.lit("None")))
    mas = F.lower(F.coalesce(col_(master), F.lit("None")))
    forced = cat.contains(rules.type_override_word) | (mas == F.lit(rules.type_override_master))
    return F.when(forced, F.lit("concentrate")).otherwise(base)


def token_sort_key(c) -> Column:
    """Whitespace tokens sorted by code point and joined with one space."""
    parts = F.filter(F.split(col_(c), "(?U)" + WS + "+"), lambda w: w != "")
    return F.array_join(F.array_sort(parts), " ")


def py_str_lower(c) -> Column:
    """``str(x).lower()`` where x may be None."""
    return F.lower(F.coalesce(col_(c), F.lit("None")))
