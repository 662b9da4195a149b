"""The matching ladder on distinct product keys.

Every outcome is a function of the product key (name, brand, and for the
inventory preset whether the row's category forces the type), so the ladder
runs once per distinct key and the result is joined back to the fact rows.

Tiers in precedence order (each later tier only sees keys the earlier ones
left open; cheap equi-joins first):

  exact name -> exact "name - brand" -> [inventory: mojibake-tolerant keys ->
  same words in another order] -> rule-constrained fuzzy top-k -> edible
  backup on categories -> preroll attribute fallback -> bulk override
  [-> inventory: failed-check diagnostics for what is left]
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planmatch import config as C
from planmatch.config import RuleSet
from planmatch.functions import text as TX
from planmatch.functions.similarity import partial_ratio_udf
from planmatch.operators import rules as R
from planmatch.operators.fuzzy import best_match, fuzzy_top_k
from planmatch.operators.joins import null_safe_join, sized_broadcast, written
from planmatch.sources import catalog as CAT

KEY = ["PRODUCTNAME", "BRANDNAME", "TYPE_FORCED"]
MATCH_COLS = ["MATCHED_SNOP_CATEGORY", "MATCH_SCORE", "MATCHED_REFERENCE", "MATCH_RESULT"]

# cp1252 bytes 0x80-0x9f that decode to a character (rule: Python's codec table)
_CP1252_SPECIALS = []
for _b in range(0x80, 0xA0):
    try:
        _CP1252_SPECIALS.append((bytes([_b]).decode("cp1252"), chr(_b)))
    except UnicodeDecodeError:
        pass
_CP1252_FROM = "".join(a for a, _ in _CP1252_SPECIALS)
_CP1252_TO = "".join(b for _, b in _CP1252_SPECIALS)


def type_forced(rules: RuleSet, category: str = "CATEGORY", master: str = "MASTERCATEGORY") -> Column:
    """Whether the row's own category columns force the 'concentrate' type (inventory)."""
    if rules.type_override_word is None:
        return F.lit(False)
    cat = F.lower(F.coalesce(F.col(category), F.lit("None")))
    mas = F.lower(F.coalesce(F.col(master), F.lit("None")))
    return cat.contains(rules.type_override_word) | (mas == F.lit(rules.type_override_master))


def product_keys(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Distinct product keys of a (gated) fact frame."""
    cols = df.columns
    forced = type_forced(rules) if ("CATEGORY" in cols and "MASTERCATEGORY" in cols) else F.lit(False)
    return df.select("PRODUCTNAME", "BRANDNAME", forced.alias("TYPE_FORCED")).distinct()


def product_features(keys: DataFrame, rules: RuleSet) -> DataFrame:
    name = F.col("PRODUCTNAME")
    base_type = TX.product_type(name, rules)
    ptype = F.when(F.col("TYPE_FORCED"), F.lit("concentrate")).otherwise(base_type)
    brand_txt = F.coalesce(F.col("BRANDNAME"), F.lit("None"))
    alt_raw = F.concat(TX.str_or_empty(name), F.lit(" - "), brand_txt)
    if rules.normalized_keys:
        exact_key = TX.normalize_text(TX.clean_text(name, rules))
        alt_key = TX.normalize_text(TX.clean_text(alt_raw, rules))
    else:
        exact_key = name
        alt_key = TX.strip_ws(alt_raw)
    cleaned = TX.match_key(name, rules)
    return keys.select(
        *KEY,
        exact_key.alias("EXACT_KEY"),
        alt_key.alias("ALT_KEY"),
        cleaned.alias("CLEANED"),
        TX.token_sort_key(cleaned).alias("TOKEN_KEY"),
        F.lower(TX.str_or_empty(name)).alias("NAME_LC"),
        TX.py_str_lower("BRANDNAME").alias("BRAND_LC"),
        TX.extract_grams(name).alias("P_GRAMS"),
        ptype.alias("P_TYPE"),
        TX.flavor_tokens(name, rules).alias("P_FLAVORS"),
        TX.flavor_string(name, rules).alias("P_FLAVOR_STR"),
        TX.strain(name).alias("P_STRAIN"),
        TX.pack_size(name).alias("P_PACK"),
        TX.pack_number(name).alias("P_PACK_NUM"),
    )


def _result(cat, score, ref, label) -> Column:
    def lit_or(c, t):
        return (c if isinstance(c, Column) else F.lit(c)).cast(t)
    return F.struct(lit_or(cat, "string").alias("cat"), lit_or(score, "double").alias("score"),
                    lit_or(ref, "string").alias("ref"), lit_or(label, "string").alias("label"))


# ---------------------------------------------------------------------------
# tiers
# ---------------------------------------------------------------------------


def exact_tiers(feats: DataFrame, emap: DataFrame) -> DataFrame:
    """Adds T_EXACT and T_ALT result structs (null when the key is absent)."""
    m1 = emap.select(F.col("KEY").alias("__k1"), F.col("CAT").alias("__c1"), F.lit(True).alias("__f1"))
    m2 = emap.select(F.col("KEY").alias("__k2"), F.col("CAT").alias("__c2"), F.lit(True).alias("__f2"))
    out = feats.join(m1, feats["EXACT_KEY"] == m1["__k1"], "left")
    out = out.join(m2, out["ALT_KEY"] == m2["__k2"], "left")
    return out.select(
        *feats.columns,
        F.when(F.col("__f1"), _result(F.col("__c1"), 100.0, F.col("EXACT_KEY"), C.LABEL_EXACT)).alias("T_EXACT"),
        F.when(F.col("__f2"), _result(F.col("__c2"), 99.0, F.col("ALT_KEY"), C.LABEL_EXACT_BRAND)).alias("T_ALT"),
    )


def _latin1_redecode(s: Column) -> Column:
    ok = s.rlike(r"^[\x00-\xFF]*$")
    return F.when(ok, F.try_validate_utf8(F.encode(s, "ISO-8859-1").cast("string")))


def _cp1252_redecode(s: Column) -> Column:
    ok = s.rlike("^[\\x00-\\x7F\\xA0-\\xFF" + _CP1252_FROM + "]*$")
    as_latin = F.translate(s, _CP1252_FROM, _CP1252_TO)
    return F.when(ok, F.try_validate_utf8(F.encode(as_latin, "ISO-8859-1").cast("string")))


def exception_keys(feats: DataFrame, rules: RuleSet) -> DataFrame:
    """(key cols, PRIO, XKEY): repaired spellings of names that contain non-ASCII text."""
    raw = TX.str_or_empty("PRODUCTNAME")
    brand = F.coalesce(F.col("BRANDNAME"), F.lit("None"))
    fixes = []
    for bad, good in C.MOJIBAKE_PAIRS:
        fixes.append(F.when(raw.contains(bad), F.replace(raw, F.lit(bad), F.lit(good))))
    fixes.append(_latin1_redecode(raw))
    fixes.append(_cp1252_redecode(raw))
    variants = []
    for i, fx in enumerate(fixes):
        variants.append(F.struct(F.lit(2 * i).alias("PRIO"), fx.alias("S")))
        variants.append(F.struct(F.lit(2 * i + 1).alias("PRIO"),
                                 F.when(fx.isNotNull(), F.concat(fx, F.lit(" - "), brand)).alias("S")))
    cand = feats.filter(~raw.rlike(r"^[\x00-\x7F]*$")).select(*KEY, F.explode(F.array(*variants)).alias("V"))
    cand = cand.filter(F.col("V.S").isNotNull()).select(
        *KEY, F.col("V.PRIO").alias("PRIO"),
        TX.normalize_text(TX.clean_text(F.col("V.S"), rules)).alias("XKEY"))
    return cand.filter(F.col("XKEY") != "")


def exception_tier(feats: DataFrame, emap: DataFrame, rules: RuleSet) -> DataFrame:
    hits = exception_keys(feats, rules).join(emap, F.col("XKEY") == F.col("KEY"), "inner")
    best = hits.groupBy(*KEY).agg(F.min_by(F.struct("CAT", "XKEY"), "PRIO").alias("B"))
    return best.select(*KEY, _result(F.col("B.CAT"), 100.0, F.col("B.XKEY"), C.LABEL_EXCEPTION).alias("T_EXCEPTION"))


def high_confidence_tier(feats: DataFrame, refs: DataFrame) -> DataFrame:
    """Best candidate scoring 100 = same sorted-token key: an equi-join, no scoring."""
    hits = feats.select(*KEY, "TOKEN_KEY").join(refs, F.col("TOKEN_KEY") == F.col("REF_TOKEN_KEY"), "inner")
    best = hits.groupBy(*KEY).agg(F.min_by(F.struct("REF_CAT", "REF_KEY"), "REF_POS").alias("B"))
    return best.select(*KEY, _result(F.col("B.REF_CAT"), 100.0, F.col("B.REF_KEY"), C.LABEL_HIGH_CONFIDENCE)
                       .alias("T_HIGH"))


def strict_candidates(open_feats: DataFrame, refs: DataFrame, rules: RuleSet) -> DataFrame:
    """Top-k candidates of the open keys that pass the veto rules.

    Scores depend only on the sorted-token text, so the top-k is computed
    once per distinct text and fanned out to the keys by an equi-join.  The
    rules that need no Python filter first; the flavour ratio sees what they leave.
    """
    texts = open_feats.select("TOKEN_KEY").distinct()
    top = fuzzy_top_k(texts, refs, rules.strict_threshold, rules.top_k)
    cand = open_feats.join(top, "TOKEN_KEY", "inner").filter(R.native_rules_pass(rules))
    return cand.filter(R.edible_flavor_check(rules))


def strict_tier(open_feats: DataFrame, refs: DataFrame, rules: RuleSet) -> DataFrame:
    """The valid candidate of the best score; equal scores go by partial ratio, which only they are asked for."""
    valid = strict_candidates(open_feats, refs, rules)
    own = Window.partitionBy(*KEY)
    best = valid.withColumn("__best", F.max("SCORE").over(own)).filter(F.col("SCORE") == F.col("__best"))
    best = best.withColumn("__tied", F.count(F.lit(1)).over(own) > 1)
    best = best.withColumn("PARTIAL", partial_ratio_udf(F.when(F.col("__tied"), F.col("REF_KEY")), F.col("CLEANED")))
    w = own.orderBy(F.col("PARTIAL").desc(), F.col("REF_POS").asc())
    first = best.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
    return first.select(*KEY, _result(F.col("REF_CAT"), F.col("SCORE"), F.col("REF_KEY"), C.LABEL_STRICT).alias("T_STRICT"))


def backup_tier(open_feats: DataFrame, cats: DataFrame, rules: RuleSet) -> DataFrame:
    """Edible keys: best partial ratio against the lower-cased categories, >= threshold."""
    edible = open_feats.filter(F.col("P_TYPE") == "edible").select(*KEY, "CLEANED")
    # scored once per distinct cleaned name
    texts = edible.select("CLEANED").distinct()
    best = best_match(texts, cats, "CLEANED", "CAT_LC", "CAT_POS", "CAT_LC", scorer="partial", min_score=rules.partial_threshold)
    joined = edible.join(best, "CLEANED", "inner")
    return joined.select(*KEY, _result(F.col("CAT_LC"), F.col("BEST_SCORE"), F.col("CAT_LC"), C.LABEL_BACKUP)
                         .alias("T_BACKUP"))


def fallback_tier(feats: DataFrame, fb: DataFrame) -> DataFrame:
    """Preroll fallback: first catalog row (by position) agreeing on strain, pack, brand and grams.

    Weights less than 0.05 apart lie in the same or in neighbouring sixteenths (an exact product of doubles), so
    the sixteenth is a join key and a brand without strain or pack is no single hot key.
    """
    cand = feats.filter(
        (F.col("P_TYPE") == "flower") & F.col("CLEANED").contains("preroll") & F.col("NAME_LC").contains("preroll")
    ).select(*KEY, "BRAND_LC", "P_STRAIN", "P_PACK_NUM", "P_GRAMS")
    step = F.floor(F.col("P_GRAMS") * 16)
    cand = cand.withColumn("P_STEP", F.explode(F.array(step - 1, step, step + 1)))
    fb = fb.withColumn("FB_STEP", F.floor(F.col("FB_GRAMS") * 16))
    cond = (
        (cand["P_STEP"] == fb["FB_STEP"])
        & (cand["BRAND_LC"] == fb["FB_BRAND"])
        & cand["P_STRAIN"].eqNullSafe(fb["FB_STRAIN"])
        & cand["P_PACK_NUM"].eqNullSafe(fb["FB_PACK"])
    )
    hits = cand.join(fb, cond, "inner").filter(
        (F.col("P_GRAMS") != 0) & (F.col("FB_GRAMS") != 0) & (F.abs(F.col("P_GRAMS") - F.col("FB_GRAMS")) < 0.05)
    )
    best = hits.groupBy(*KEY).agg(F.min_by(F.struct("FB_CAT", "FB_NAME"), "FB_POS").alias("B"))
    return best.select(*KEY, _result(F.col("B.FB_CAT"), 90.0, F.col("B.FB_NAME"), C.LABEL_FALLBACK).alias("T_FALLBACK"))


def bulk_override(res: Column, rules: RuleSet) -> Column:
    cat = res["cat"]
    missing = cat.isNull() | (cat == "") if rules.bulk_blank_is_missing else cat.isNull()
    name = F.col("NAME_LC")
    premium = F.col("BRAND_LC").contains(rules.bulk_premium_keyword)
    if rules.bulk_brand_or_name:
        premium = premium | name.contains(rules.bulk_premium_keyword)
    override = F.when(
        premium,
        _result(rules.bulk_premium_category, rules.bulk_premium_score, "bulk name brand rule", C.LABEL_BULK),
    ).otherwise(_result(rules.bulk_default_category, rules.bulk_default_score, "bulk name rule", C.LABEL_BULK))
    return F.when(F.coalesce(missing, F.lit(False)) & name.contains("bulk"), override).otherwise(res)


def assemble(state: DataFrame, rules: RuleSet) -> DataFrame:
    """Apply precedence over the tier structs present in ``state`` (staged columns keep
    each generated expression small)."""
    no_match = _result(None, None, None, C.LABEL_NO_MATCH)
    exact_like = [c for c in ("T_EXACT", "T_ALT", "T_EXCEPTION", "T_HIGH") if c in state.columns]
    fuzzy_like = [c for c in ("T_STRICT", "T_BACKUP") if c in state.columns]
    exact_hit = F.coalesce(*[F.col(c).isNotNull() for c in exact_like], F.lit(False)) if exact_like else F.lit(False)
    fb_guard = F.coalesce((F.col("P_TYPE") == "flower") & F.col("CLEANED").contains("preroll"), F.lit(False))
    state = state.withColumns({
        "__chain": F.coalesce(*[F.col(c) for c in exact_like + fuzzy_like], no_match),
        "__exact_hit": exact_hit,
        "__fb_guard": fb_guard,
    })
    chain, fb = F.col("__chain"), F.col("T_FALLBACK")
    if rules.fallback_overwrites:
        # sales: exact tiers skip the fallback; a missing category elsewhere takes
        # the fallback result, or "no acceptable match" when it finds nothing
        cat = chain["cat"]
        take = ~F.col("__exact_hit") & (cat.isNull() | (cat == "")) & F.col("__fb_guard")
        res = F.when(F.coalesce(take, F.lit(False)), F.coalesce(fb, no_match)).otherwise(chain)
    else:
        # inventory: a null category takes the fallback only when it yields a category
        take = chain["cat"].isNull() & F.col("__fb_guard") & fb.isNotNull() & (F.coalesce(fb["cat"], F.lit("")) != "")
        res = F.when(F.coalesce(take, F.lit(False)), fb).otherwise(chain)
    state = state.withColumn("__res0", res)
    state = state.withColumn("RES", bulk_override(F.col("__res0"), rules))
    return state.drop("__chain", "__exact_hit", "__fb_guard", "__res0")


def diagnostics(unmatched: DataFrame, refs: DataFrame, rules: RuleSet) -> DataFrame:
    """Failed veto checks against the single best candidate (no threshold, whole catalog)."""
    # the best candidate depends on the sorted-token text only: one search per text
    texts = unmatched.select("TOKEN_KEY").distinct()
    best = best_match(texts, refs, "TOKEN_KEY", "REF_TOKEN_KEY", "REF_POS", "REF_KEY").select("TOKEN_KEY", "REF_KEY", "REF_CAT", "REF_GRAMS", "REF_PACK")
    joined = unmatched.join(best, "TOKEN_KEY", "left")
    # no candidate at all: category '' and no name (the original's empty defaults)
    joined = joined.withColumn("REF_CAT", F.when(F.col("REF_KEY").isNull(), F.lit("")).otherwise(F.col("REF_CAT")))
    return joined.select(*KEY, R.failed_checks(rules).alias("FAILED_CHECKS"))


# ---------------------------------------------------------------------------
# the whole ladder
# ---------------------------------------------------------------------------


class Catalog:
    """Catalog derivations for one preset, each made when first asked for and written once.

    So are the catalog's rows that they are made from.  The tiers read what was written, so names are cleaned and
    folded once a run, and the files' size decides without a job whether a derivation is broadcast.
    """

    def __init__(self, catalog: DataFrame, rules: RuleSet, pos_col: str = CAT.POS):
        self.prepared = CAT.prepare_catalog(catalog, pos_col)
        self.rules = rules

    @cached_property
    def rows(self) -> DataFrame:
        return written(self.prepared, "catalog-rows")

    @cached_property
    def exact(self) -> DataFrame:
        return sized_broadcast(written(CAT.exact_map(self.rows, self.rules), "catalog-exact"))[0]

    @cached_property
    def refs(self) -> DataFrame:
        return sized_broadcast(written(CAT.reference_names(self.rows, self.rules), "catalog-names"))[0]

    @cached_property
    def categories(self) -> DataFrame:
        return written(CAT.category_list(self.rows), "catalog-categories")

    @cached_property
    def fallback(self) -> DataFrame:
        return sized_broadcast(written(CAT.fallback_rows(self.rows, self.rules), "catalog-prerolls"))[0]


def match_keys(keys: DataFrame, catalog: Catalog, rules: RuleSet, with_diagnostics: bool | None = None) -> DataFrame:
    """One row per key: KEY + MATCHED_SNOP_CATEGORY, MATCH_SCORE, MATCHED_REFERENCE,
    MATCH_RESULT (+ FAILED_CHECKS for the inventory preset) + product features.

    The per-key intermediates (features, the state after the exact tiers, the
    strict matches) feed several later tiers.  They are small (one row per
    distinct key), so each is written once and read back: later tiers plan a
    short scan instead of the whole chain of text expressions.
    """
    feats = written(product_features(keys, rules), "key-features")
    state = exact_tiers(feats, catalog.exact)
    if rules.name_exceptions:
        state = null_safe_join(state, exception_tier(feats, catalog.exact, rules), KEY)
    if rules.high_confidence:
        state = null_safe_join(state, high_confidence_tier(feats, catalog.refs), KEY)
    state = written(state, "key-state")
    pre = [c for c in ("T_EXACT", "T_ALT", "T_EXCEPTION", "T_HIGH") if c in state.columns]
    open_keys = state.filter(F.coalesce(*[F.col(c) for c in pre]).isNull()).select(*feats.columns)
    strict = written(strict_tier(open_keys, catalog.refs, rules), "key-strict")
    state = null_safe_join(state, strict, KEY)
    open2 = null_safe_join(open_keys, strict.select(*KEY), KEY, "left_anti")
    state = null_safe_join(state, backup_tier(open2, catalog.categories, rules), KEY)
    state = null_safe_join(state, fallback_tier(feats, catalog.fallback), KEY)
    state = assemble(state, rules)
    out = state.select(
        *feats.columns,
        F.col("RES.cat").alias("MATCHED_SNOP_CATEGORY"),
        F.col("RES.score").alias("MATCH_SCORE"),
        F.col("RES.ref").alias("MATCHED_REFERENCE"),
        F.col("RES.label").alias("MATCH_RESULT"),
    )
    if with_diagnostics is None:
        with_diagnostics = rules.diagnostics
    if with_diagnostics:
        out = written(out, "key-matched")
        left = out.filter(F.col("MATCH_RESULT") == C.LABEL_NO_MATCH)
        diag = diagnostics(left, catalog.refs, rules)
        out = null_safe_join(out, diag, KEY)
    return out
