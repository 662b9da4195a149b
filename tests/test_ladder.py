"""Ladder tiers on small in-memory catalogs, and the distributed fuzzy join
against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from planmatch import config as C
from planmatch.config import FIXTURE_INVENTORY as INV
from planmatch.config import FIXTURE_SALES as SAL
from planmatch.functions import similarity as S
from planmatch.operators import ladder as L
from planmatch.operators import fuzzy
from planmatch.operators.fuzzy import NameIndex, best_match, fuzzy_top_k
from planmatch.operators.overrides import direct_sku_match, trim_bulk_override
from planmatch.config import FIXTURE_WHOLESALE as WHO

CAT = "CATALOGPOS long, PRODUCTNAME string, SNOPCATEGORY string, BRAND string"


def catalog(spark, rows):
    return spark.createDataFrame(rows, CAT)


def keys(spark, rows):
    return spark.createDataFrame([(n, b, False) for n, b in rows], "PRODUCTNAME string, BRANDNAME string, TYPE_FORCED boolean")


def results(spark, rules, cat_rows, key_rows):
    out = L.match_keys(keys(spark, key_rows), L.Catalog(catalog(spark, cat_rows), rules), rules)
    return {r["PRODUCTNAME"]: r for r in out.collect()}


def test_sales_tiers(spark):
    cat = [(1, "Red Ring Indica Flower 3.5g", "Brand#9 Indica Flower", "Brand#9"),
           (2, "Blue Rod Sativa Preroll 1g (5pk) - Brand#9", "Brand#9 Sativa Preroll", "Brand#9"),
           (3, "Sour Lime Hybrid Gummies", "Brand#9 Hybrid Gummies", "Brand#9"),
           (4, "Green Gear Sativa Preroll 1g (5pk)", "Brand#7 Sativa Preroll", "brand#3")]
    res = results(spark, SAL, cat, [
        ("Red Ring Indica Flower 3.5g", "Brand#9"),          # exact
        ("Blue Rod Sativa Preroll 1g (5pk)", "Brand#9"),     # exact with brand
        ("AU:red ring indica flower 3.5g x", "Brand#9"),     # strict fuzzy
        ("Lime Zest Hybrid Gummies", "Brand#9"),             # edible backup on categories
        ("Pink Sativa Preroll 1g (5pk)", "Brand#3"),         # brand lock vetoes strict -> preroll fallback
        ("Nothing Bulk", "Brand#1"),                         # bulk override, premium brand
        ("Nothing Else", "Brand#9"),                         # no match
    ])
    assert res["Red Ring Indica Flower 3.5g"]["MATCH_RESULT"] == C.LABEL_EXACT
    assert res["Blue Rod Sativa Preroll 1g (5pk)"]["MATCH_RESULT"] == C.LABEL_EXACT_BRAND
    assert res["Blue Rod Sativa Preroll 1g (5pk)"]["MATCH_SCORE"] == 99.0
    r = res["AU:red ring indica flower 3.5g x"]
    assert (r["MATCH_RESULT"], r["MATCHED_REFERENCE"]) == (C.LABEL_STRICT, "red ring indica flower 3.5g")
    assert abs(r["MATCH_SCORE"] - S.ratio("3.5g flower indica red ring x", "3.5g flower indica red ring")) < 1e-9
    r = res["Lime Zest Hybrid Gummies"]
    assert r["MATCH_RESULT"] == C.LABEL_BACKUP and r["MATCHED_SNOP_CATEGORY"] == "brand#9 hybrid gummies"
    r = res["Pink Sativa Preroll 1g (5pk)"]
    assert (r["MATCH_RESULT"], r["MATCHED_SNOP_CATEGORY"], r["MATCH_SCORE"]) == (C.LABEL_FALLBACK, "Brand#7 Sativa Preroll", 90.0)
    r = res["Nothing Bulk"]
    assert (r["MATCH_RESULT"], r["MATCHED_SNOP_CATEGORY"], r["MATCH_SCORE"]) == (C.LABEL_BULK, C.BULK_PREMIUM_CATEGORY, 100.0)
    assert res["Nothing Else"]["MATCH_RESULT"] == C.LABEL_NO_MATCH


def test_inventory_tiers(spark):
    cat = [(1, "Café Rod Indica Flower 3.5g", "Brand#9 Indica Flower", "Brand#9"),
           (2, "Gear Hot Sativa Flower 7g", "Brand#9 Sativa Flower", "Brand#9"),
           (3, "Null Cat Flower 1g", None, "Brand#9")]
    res = results(spark, INV, cat, [
        ("CafÃ© Rod Indica Flower 3.5g", "Brand#9"),   # mojibake -> name exception (latin-1 repair)
        ("Hot Gear Sativa Flower 7g", "Brand#9"),      # same words, other order -> high confidence
        ("Null Cat Flower 1g", "Brand#9"),             # exact with null category
        ("Zzz Qqq Indica", "Brand#9"),                 # no match -> diagnostics
    ])
    assert res["CafÃ© Rod Indica Flower 3.5g"]["MATCH_RESULT"] in (C.LABEL_EXACT, C.LABEL_EXCEPTION)
    assert res["CafÃ© Rod Indica Flower 3.5g"]["MATCHED_SNOP_CATEGORY"] == "Brand#9 Indica Flower"
    assert res["Hot Gear Sativa Flower 7g"]["MATCH_RESULT"] == C.LABEL_HIGH_CONFIDENCE
    r = res["Null Cat Flower 1g"]
    assert r["MATCH_RESULT"] == C.LABEL_EXACT and r["MATCHED_SNOP_CATEGORY"] is None
    r = res["Zzz Qqq Indica"]
    assert r["MATCH_RESULT"] == C.LABEL_NO_MATCH and r["FAILED_CHECKS"] is not None


def _names(rnd, n, most=5):
    words = ["red", "ring", "blue", "rod", "flower", "indica", "gummies", "1g", "3.5g", "sativa", "x", "éñ日", "a" * 70]
    return sorted({" ".join(rnd.sample(words, rnd.randint(0, most))) for _ in range(n)})


def _refs(spark, refs):
    return spark.createDataFrame([(r, i, S.token_sort(r)) for i, r in enumerate(refs)], "REF_KEY string, REF_POS long, REF_TOKEN_KEY string")


@pytest.mark.parametrize("shard, block", [(200_000, 2048), (30, 7)])
def test_fuzzy_top_k_equals_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(fuzzy, "SHARD_ROWS", shard)
    monkeypatch.setattr(fuzzy, "BLOCK_ROWS", block)
    rnd = random.Random(3)
    refs, prods = _names(rnd, 120), {S.token_sort(p) for p in [*_names(rnd, 60), "abcd", "abcx", "", "blue red"]}
    refs += ["abcx", "abcd", "abc"]  # abcd against abcx: exactly 75
    texts = spark.createDataFrame([(p,) for p in [*prods, None]], "TOKEN_KEY string")
    got = {(r["TOKEN_KEY"], r["REF_KEY"], r["RANK"], r["SCORE"]) for r in fuzzy_top_k(texts, _refs(spark, refs), 75.0, 5).collect()}
    want = set()
    for p in prods:
        scored = sorted(((S.ratio(p, S.token_sort(r)), i, r) for i, r in enumerate(refs)), key=lambda t: (-t[0], t[1]))
        want |= {(p, r, rank, sc) for rank, (sc, _, r) in enumerate(scored[:5], start=1) if sc >= 75}
    assert got == want and ("abcd", "abcx", 3, 75.0) in got


@pytest.mark.parametrize("scorer, least", [("ratio", None), ("partial", None), ("partial", 70.0)])
@pytest.mark.parametrize("shard, block", [(200_000, 2048), (30, 7)])
def test_best_match_equals_brute_force(spark, monkeypatch, scorer, least, shard, block):
    monkeypatch.setattr(fuzzy, "SHARD_ROWS", shard)
    monkeypatch.setattr(fuzzy, "BLOCK_ROWS", block)
    rnd = random.Random(4)
    refs, prods = _names(rnd, 70), [*_names(rnd, 30, 3), "zzz", "q"]
    texts = spark.createDataFrame([(p,) for p in [*prods, None]], "T string")
    got = {r["T"]: (r["REF_KEY"], r["BEST_SCORE"]) for r in best_match(texts, _refs(spark, refs), "T", "REF_KEY", "REF_POS", "REF_KEY", scorer, least).collect()}
    score = S.ratio if scorer == "ratio" else S.partial_ratio
    want = {}
    for p in prods:
        best = max((score(p, r), -i, r) for i, r in enumerate(refs))
        if least is None or best[0] >= least:
            want[p] = (best[2], best[0])
    assert got == want
    assert best_match(texts, _refs(spark, refs).limit(0), "T", "REF_KEY", "REF_POS", "REF_KEY", scorer, least).count() == 0


def test_most_pairs_are_never_scored():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 9))) for _ in range(200)]
    refs = [" ".join(rnd.sample(words, 4)) for _ in range(3_000)]
    texts = [r.replace("e", "i", 1) + " x" for r in refs[::30]]
    _, _, _, stats = NameIndex(refs).search(texts, 5, 75.0)
    assert stats["pairs"] == 300_000 and stats["scored"] < stats["pairs"] / 20


def test_no_pair_is_a_row_of_the_plan(spark):
    """Only texts and what was found are rows: no join below the search, no cogroup."""
    texts = spark.createDataFrame([("abc",)], "TOKEN_KEY string")
    plan = fuzzy_top_k(texts, _refs(spark, ["abc", "abd"]), 75.0, 5)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert "Join" not in below[: below.index("LogicalRDD")] and "CoGroup" not in plan and "Generate" not in plan


def test_wholesale_override(spark):
    df = spark.createDataFrame([("a TRIM", "Brand#1", None), ("b bulk", "x", ""), ("c", "x", None), ("d", "x", "SKU")],
                               "PRODUCTNAME string, BRANDNAME string, PRODUCTSKU string")
    out = {r["PRODUCTNAME"]: r for r in trim_bulk_override(direct_sku_match(df), WHO).collect()}
    assert (out["a TRIM"]["MATCH_RESULT"], out["a TRIM"]["MATCH_SCORE"]) == (C.LABEL_TRIM, 95.0)
    assert out["a TRIM"]["MATCHED_REFERENCE"] == "trim name brand rule"
    assert (out["b bulk"]["MATCH_RESULT"], out["b bulk"]["MATCHED_SNOP_CATEGORY"]) == (C.LABEL_BULK, C.BULK_DEFAULT_CATEGORY)
    assert out["c"]["MATCH_RESULT"] == C.LABEL_MISSING_SKU
    assert out["d"]["MATCHED_SNOP_CATEGORY"] == "SKU"


def test_sized_broadcast_checks_rows_and_bytes(spark):
    from planmatch.operators.joins import sized_broadcast
    df = spark.createDataFrame([(i, "x" * 50) for i in range(10)], "id int, s string")
    assert sized_broadcast(df)[1]
    assert not sized_broadcast(df, max_rows=9)[1]
    assert not sized_broadcast(df, max_bytes=100)[1]
    assert sized_broadcast(df.limit(0))[1]


def test_character_bound_is_never_below_the_score():
    texts = ["", "abcd", "abcx", "abc", "abcde", "éñ日本", "éñ日x", "ab cd ef", "a" * 80, "a" * 50 + "b" * 30, "1.5g", "15g"]
    a, b = [x for x in texts for _ in texts], texts * len(texts)
    shared = S.np.minimum(S.char_counts(a), S.char_counts(b)).sum(1)
    bound = S.scores_of(S.np.array([len(x) + len(y) for x, y in zip(a, b)]), shared)
    assert (bound >= S.ratio_batch(a, b)).all() and (bound > S.ratio_batch(a, b)).any()


def test_size_is_proven_by_the_plan_without_a_job(spark, sf_small):
    """A frame over small files is broadcast by its statistics; a generator or unknown size is counted."""
    from planmatch.operators.joins import plan_bytes, sized_broadcast
    parts = spark.read.parquet(f"{sf_small}/part.parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("size", "size")
    try:
        assert sized_broadcast(parts.groupBy("p_name").count())[1] and not tracker.getJobIdsForGroup("size")
        assert plan_bytes(parts.select(F.explode(F.sequence(F.lit(1), F.col("p_size"))))) is None
        assert not sized_broadcast(parts, max_bytes=10)[1] and tracker.getJobIdsForGroup("size")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_ties_alone_are_asked_for_a_partial_ratio(spark):
    """Two catalog names of one score: the partial ratio decides; where the best is alone none is scored."""
    cat = [(1, "Flower Indica Ring Red 3.5g", "Brand#9 Indica Flower", "Brand#9"), (2, "Red Ring Indica Flower 3.5g", "Brand#9 Indica Flower", "Brand#9"),
           (3, "Blue Gear Indica Flower 3.5g", "Brand#9 Indica Flower", "Brand#9")]
    keys_ = L.product_features(keys(spark, [("Red Rings Indica Flower 3.5g", "Brand#9"), ("Blue Gearx Indica Flower 3.5g", "Brand#9")]), SAL)
    refs = L.Catalog(catalog(spark, cat), SAL).refs
    valid = L.strict_candidates(keys_, refs, SAL).collect()
    got = {r["PRODUCTNAME"]: r["T_STRICT"] for r in L.strict_tier(keys_, refs, SAL).collect()}
    for name, own in got.items():
        mine = [r for r in valid if r["PRODUCTNAME"] == name]
        best = max(mine, key=lambda r: (r["SCORE"], S.partial_ratio(r["REF_KEY"], r["CLEANED"]), -r["REF_POS"]))
        assert own["ref"] == best["REF_KEY"]
    tied = [r for r in valid if r["PRODUCTNAME"] == "Red Rings Indica Flower 3.5g"][:2]
    assert tied[0]["SCORE"] == tied[1]["SCORE"] and got["Red Rings Indica Flower 3.5g"]["ref"] == "red ring indica flower 3.5g"


def test_fallback_takes_weights_less_than_a_twentieth_apart(spark):
    rows = [(i, g) for i, g in enumerate([0.04, 0.0, 0.96, 1.0, 1.04, 1.06, 3.5, None])]
    cand = spark.createDataFrame([(f"n{i}", "b", False, "flower", "preroll", "preroll", "b", None, None, g) for i, g in rows],
                                 "PRODUCTNAME string, BRANDNAME string, TYPE_FORCED boolean, P_TYPE string, CLEANED string, "
                                 "NAME_LC string, BRAND_LC string, P_STRAIN string, P_PACK_NUM int, P_GRAMS double")
    fb = spark.createDataFrame([("b", None, None, 1.0, "cat", "one", 1), ("b", None, None, 0.0625, "cat", "small", 2)],
                               "FB_BRAND string, FB_STRAIN string, FB_PACK int, FB_GRAMS double, FB_CAT string, FB_NAME string, FB_POS long")
    got = {r["PRODUCTNAME"]: r["T_FALLBACK"]["ref"] for r in L.fallback_tier(cand, fb).collect()}
    assert got == {"n0": "small", "n2": "one", "n3": "one", "n4": "one"}
