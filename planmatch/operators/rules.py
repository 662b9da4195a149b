"""Veto rules over (product, candidate) pairs as Boolean Columns (never null).

Product-side columns: NAME_LC (lower-cased raw name), BRANDNAME, P_TYPE,
P_GRAMS, P_STRAIN, P_PACK, P_FLAVORS, P_FLAVOR_STR.
Candidate-side columns: REF_CAT (category, may be null), REF_GRAMS, REF_PACK,
REF_FLAVORS, REF_FLAVOR_STR.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from planmatch.config import RuleSet
from planmatch.functions.similarity import ratio_udf
from planmatch.functions.text import contains_any, py_str_lower, strain, strip_ws


def _mc() -> Column:
    return py_str_lower("REF_CAT")


def grams_check(rules: RuleSet, p="P_GRAMS", m="REF_GRAMS", t="P_TYPE") -> Column:
    pg, mg, pt = F.col(p), F.col(m), F.col(t)
    zero = (pg == 0.0) | (mg == 0.0)
    typed = pt.isin(list(rules.grams_types))
    missing = pg.isNull() | mg.isNull()
    band = ~(((pg > 7) & (mg <= 3.5)) | ((mg > 7) & (pg <= 3.5))) & (F.abs(pg - mg) <= 0.05)
    if rules.missing_grams == "skip":
        ok = zero | missing | ~F.coalesce(typed, F.lit(False)) | band
    else:
        ok = zero | ~F.coalesce(typed, F.lit(False)) | (~missing & band)
    return F.coalesce(ok, F.lit(False))


def flavor_check(rules: RuleSet, asked: Column | None = None) -> Column:
    """Two flavour words in common, or close flavour texts; the ratio is scored only for ``asked`` rows that need it."""
    ref = F.col("REF_FLAVORS")
    common = F.size(F.array_intersect(F.col("P_FLAVORS"), ref)) >= 2
    needed = ~common & (F.size(ref) > 0)
    if asked is not None:
        needed = needed & asked
    close = ratio_udf(F.when(needed, F.col("P_FLAVOR_STR")), F.col("REF_FLAVOR_STR")) >= rules.flavor_threshold
    ok = (F.size(ref) > 0) & (common | close)
    return F.coalesce(ok, F.lit(False))


def edible_flavor_check(rules: RuleSet) -> Column:
    edible = F.coalesce(F.col("P_TYPE"), F.lit("")) == "edible"
    return ~edible | flavor_check(rules, edible)


def strain_check() -> Column:
    ms = strain(F.col("REF_CAT"))
    return F.coalesce(F.col("P_STRAIN").isNull() | ms.isNull() | (F.col("P_STRAIN") == ms), F.lit(True))


def pr_lock(rules: RuleSet) -> Column:
    name, mc = F.col("NAME_LC"), _mc()
    if rules.pr_lock == "sales":
        bad = (name.contains("pr") | name.contains("preroll")) & (mc.contains("concentrate") | mc.contains("vape"))
    else:
        bad = mc.contains("preroll") & ~name.contains("preroll")
    return ~bad


def infused_lock() -> Column:
    return F.col("NAME_LC").contains("infused") == _mc().contains("infused")


def preground_lock(rules: RuleSet) -> Column:
    return ~(contains_any(F.col("NAME_LC"), rules.preground_words) & _mc().contains("preroll"))


def brand_category_lock(rules: RuleSet) -> Column:
    brand = F.col("BRANDNAME")
    cat = F.col("REF_CAT")
    skip = brand.isNull() | (brand == "") | cat.isNull() | (cat == "")
    pb = F.lower(strip_ws(brand))
    mc = F.lower(cat)
    bad = F.lit(False)
    for b, keywords in rules.brand_locks:
        bad = bad | ((pb == F.lit(b)) & ~contains_any(mc, keywords))
    return F.coalesce(skip | ~bad, F.lit(True))


def strain_strict_lock(rules: RuleSet) -> Column:
    ms = strain(F.col("REF_CAT"))
    ps = F.col("P_STRAIN")
    known = ps.isNotNull() & ms.isNotNull()
    flower = F.coalesce(F.col("P_TYPE") == "flower", F.lit(False))
    ok = ~flower | F.when(known, ps == ms).otherwise(F.lit(rules.strain_strict_unknown_passes))
    return F.coalesce(ok, F.lit(False))


def category_type_conflict_lock() -> Column:
    pt, mc = F.coalesce(F.col("P_TYPE"), F.lit("")), _mc()
    return ~(((pt == "flower") & mc.contains("concentrate")) | ((pt == "concentrate") & mc.contains("flower")))


def packaging_lock() -> Column:
    p, m = F.col("P_PACK"), F.col("REF_PACK")
    same = F.when(p.isNotNull() & m.isNotNull(), p == m).otherwise(p.isNull() & m.isNull())
    return ~F.col("NAME_LC").contains("preroll") | same


def veto_checks(rules: RuleSet) -> list[tuple[str, Column]]:
    """The veto rules of the preset, in the original evaluation order."""
    checks = [("grams_check", grams_check(rules)), ("flavor_check", edible_flavor_check(rules)),
              ("pr_lock", pr_lock(rules))]
    if rules.type_conflict_lock:
        checks.append(("type_conflict", category_type_conflict_lock()))
    if rules.packaging_lock:
        checks.append(("packaging", packaging_lock()))
    checks += [
        ("infused_lock", infused_lock()),
        ("strain_check", strain_check()),
        ("preground_lock", preground_lock(rules)),
        ("brand_lock", brand_category_lock(rules)),
        ("strain_strict_lock", strain_strict_lock(rules)),
    ]
    return checks


def all_rules_pass(rules: RuleSet) -> Column:
    return reduce(lambda a, b: a & b, [c for _, c in veto_checks(rules)])


def native_rules_pass(rules: RuleSet) -> Column:
    """All rules but the flavour ratio: no Python, so they filter below the scorer."""
    return reduce(lambda a, b: a & b, [c for name, c in veto_checks(rules) if name != "flavor_check"])


# Diagnostic order of the failed-check report (the flavour check is not part of it).
DIAGNOSTIC_ORDER = ("pr_lock", "type_conflict", "packaging", "brand_lock", "infused_lock",
                    "strain_check", "strain_strict_lock", "grams_check")


def failed_checks(rules: RuleSet) -> Column:
    named = {
        "pr_lock": pr_lock(rules),
        "type_conflict": category_type_conflict_lock(),
        "packaging": packaging_lock(),
        "brand_lock": brand_category_lock(rules),
        "infused_lock": infused_lock(),
        "strain_check": strain_check(),
        "strain_strict_lock": strain_strict_lock(rules),
        "grams_check": grams_check(rules),
    }
    return F.concat_ws(",", *[F.when(~named[n], F.lit(n)) for n in DIAGNOSTIC_ORDER])
