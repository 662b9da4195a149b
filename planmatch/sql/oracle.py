"""DuckDB oracle SQL per registered query.

Written independently of the Spark code: plain SQL over the driver tables,
with the fixture views inlined as CTEs.  DuckDB has no NFKD; the oracle maps
the compatibility characters present in the fixtures (superscript digits)
before ``strip_accents``.  Every query has an entry, the fuzzy tiers and both
ladders included.
"""

from __future__ import annotations

import re

from planmatch.config import FIXTURE_BRANDS, FIXTURE_BUYERS, FIXTURE_MASTER
from planmatch.config import (
    CONCENTRATE_WORDS,
    EDIBLE_WORDS,
    FLAVOR_STOP_WORDS,
    FLOWER_WORDS_INVENTORY,
    FLOWER_WORDS_SALES,
    PREROLL_WORDS,
    VAPE_WORDS,
)
from planmatch.sources.fixtures import duckdb_ctes


def _lits(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


MASTER = _lits(FIXTURE_MASTER)
BRANDS = _lits(FIXTURE_BRANDS)
BRANDS_LC = _lits(sorted({b.lower() for b in FIXTURE_BRANDS}))
BUYERS = _lits(FIXTURE_BUYERS)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def clean(x: str) -> str:
    return f"lower({strip(f'replace(replace(coalesce({x}, {chr(39)}{chr(39)}), {chr(39)}AU:{chr(39)}, {chr(39)}{chr(39)}), {chr(39)}MED:{chr(39)}, {chr(39)}{chr(39)})')})"


def normalize(x: str) -> str:
    folded = (f"regexp_replace(strip_accents(replace(replace(replace(coalesce({x}, ''), '¹', '1'), '²', '2'), '³', '3')),"
              r" '[^\x00-\x7F]', '', 'g')")
    return f"lower({strip(rf'regexp_replace({folded}, {chr(39)}\s+{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')})"


def any_of(t: str, words) -> str:
    return "(" + " OR ".join(f"contains({t}, '{w}')" for w in words) + ")"


def grams(x: str) -> str:
    pat = r"'(\d+\.?\d*)(g|mg)'"
    v = f"TRY_CAST(regexp_extract(lower({x}), {pat}, 1) AS DOUBLE)"
    u = f"regexp_extract(lower({x}), {pat}, 2)"
    return f"(CASE {u} WHEN 'g' THEN {v} WHEN 'mg' THEN round({v} / 1000.0, 4) END)"


def type_sales(x: str) -> str:
    t = f"lower({x})"
    return (f"(CASE WHEN {any_of(t, FLOWER_WORDS_SALES)} THEN 'flower' WHEN {any_of(t, VAPE_WORDS)} THEN 'vape' "
            f"WHEN {any_of(t, CONCENTRATE_WORDS)} THEN 'concentrate' WHEN {any_of(t, EDIBLE_WORDS)} THEN 'edible' END)")


def type_inventory(x: str) -> str:
    t = f"lower({x})"
    return (f"(CASE WHEN {any_of(t, CONCENTRATE_WORDS)} THEN 'concentrate' WHEN {any_of(t, EDIBLE_WORDS)} THEN 'edible' "
            f"WHEN {any_of(t, PREROLL_WORDS)} THEN 'flower' WHEN regexp_matches({t}, '\\b(\\d+(\\.\\d+)?g)\\b') THEN 'flower' "
            f"WHEN {any_of(t, FLOWER_WORDS_INVENTORY)} THEN 'flower' WHEN {any_of(t, VAPE_WORDS)} THEN 'vape' END)")


def forced(cat: str = "CATEGORY", master: str = "MASTERCATEGORY") -> str:
    return f"(contains(lower(coalesce({cat}, 'None')), 'concentrate') OR lower(coalesce({master}, 'None')) = 'mips')"


def remove_words(t: str) -> str:
    for w in FLAVOR_STOP_WORDS:
        t = f"replace({t}, '{w}', '')"
    return t


def flavor_text(x: str, letters_first: bool) -> str:
    low = f"lower(coalesce({x}, ''))"
    if letters_first:
        return remove_words(rf"regexp_replace({low}, '[^a-zA-Z\s]', '', 'g')")
    return rf"regexp_replace({remove_words(low)}, '[^a-zA-Z\s]', '', 'g')"


def tokens(x: str, letters_first: bool) -> str:
    return rf"array_to_string(list_filter(string_split_regex({flavor_text(x, letters_first)}, '\s+'), lambda w: length(w) >= 3), '|')"


def strain(x: str) -> str:
    t = f"lower(coalesce({x}, ''))"
    return f"(CASE WHEN contains({t}, 'hybrid') THEN 'hybrid' WHEN contains({t}, 'indica') THEN 'indica' WHEN contains({t}, 'sativa') THEN 'sativa' END)"


def pack(x: str) -> str:
    return rf"nullif(regexp_extract(lower({x}), '\((\d+)pk\)', 1), '')"


def token_key(x: str) -> str:
    return rf"array_to_string(list_sort(list_filter(string_split_regex({x}, '\s+'), lambda w: w <> '')), ' ')"


def sales_gate(b: str = "BRANDNAME") -> str:
    return f"lower({strip(f'coalesce({b}, {chr(39)}None{chr(39)})')}) IN ({BRANDS_LC})"


def inv_gate(b: str = "BRANDNAME") -> str:
    return f"{b} IN ({BRANDS})"


AS_OF_W = "(SELECT max(DELIVERYDATE) FROM wholesale_sales)"
AS_OF_R = "(SELECT max(TRANSACTIONDATE) FROM retail_sales)"

# --------------------------------------------------------------------------- M1

_W_EXTRACT = f"""
w_ext AS (
  SELECT 'Wholesale' AS LOCATIONNAME, DELIVERYDATE AS TRANSACTIONDATE, PRODUCTNAME, BRAND AS BRANDNAME, PRODUCTSKU,
         WEIGHTUNIT, UNITSPERCASE, PRODUCTSKU AS SNOP_CATEGORY, BUYERNAME,
         sum(QUANTITY) AS QUANTITY, sum(LINETOTAL) AS TOTAL_REVENUE
  FROM wholesale_sales
  WHERE DELIVERYDATE BETWEEN {AS_OF_W} - 90 AND {AS_OF_W}
    AND lower(BUYERNAME) NOT IN ({BUYERS})
  GROUP BY DELIVERYDATE, PRODUCTNAME, BRAND, PRODUCTSKU, WEIGHTUNIT, UNITSPERCASE, BUYERNAME),
w_lab AS (
  SELECT *,
    CASE WHEN coalesce({strip('WEIGHTUNIT')}, '') = 'Grams'
           THEN CASE WHEN contains(upper(coalesce(PRODUCTNAME, '')), 'BULK') OR contains(upper(coalesce(PRODUCTNAME, '')), 'TRIM')
                     THEN coalesce(QUANTITY, 0.0) * 453.6 ELSE coalesce(QUANTITY, 0.0) END
         WHEN coalesce({strip('WEIGHTUNIT')}, '') IN ('Units', 'Unit') THEN coalesce(QUANTITY, 0.0)
         ELSE coalesce(QUANTITY, 0.0) * coalesce(CAST(UNITSPERCASE AS DOUBLE), 1.0) END AS UNIT_COUNT,
    PRODUCTSKU AS MATCHED_SNOP_CATEGORY,
    CASE WHEN PRODUCTSKU IS NOT NULL THEN CAST(100 AS DOUBLE) END AS MATCH_SCORE,
    CASE WHEN PRODUCTSKU IS NOT NULL THEN 'wholesale direct' END AS MATCHED_REFERENCE,
    CASE WHEN PRODUCTSKU IS NOT NULL THEN 'Matched (wholesale clean)' ELSE 'Missing SKU' END AS MATCH_RESULT
  FROM w_ext)"""

W_CTE = duckdb_ctes(["wholesale_sales"]) + "," + _W_EXTRACT

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["wholesale_extract"] = W_CTE + """
SELECT LOCATIONNAME, TRANSACTIONDATE, PRODUCTNAME, BRANDNAME, PRODUCTSKU, WEIGHTUNIT,
       CAST(UNITSPERCASE AS DOUBLE) AS UNITSPERCASE, SNOP_CATEGORY,
       BUYERNAME, round(QUANTITY, 2) AS QUANTITY, round(TOTAL_REVENUE, 2) AS TOTAL_REVENUE
FROM w_ext"""

ORACLE_SQL["wholesale_units"] = W_CTE + """
SELECT LOCATIONNAME, TRANSACTIONDATE, PRODUCTNAME, BRANDNAME, PRODUCTSKU, WEIGHTUNIT,
       CAST(UNITSPERCASE AS DOUBLE) AS UNITSPERCASE, SNOP_CATEGORY,
       BUYERNAME, round(QUANTITY, 2) AS QUANTITY, round(TOTAL_REVENUE, 2) AS TOTAL_REVENUE, round(UNIT_COUNT, 2) AS UNIT_COUNT,
       MATCHED_SNOP_CATEGORY, MATCH_SCORE, MATCHED_REFERENCE, MATCH_RESULT
FROM w_lab"""

ORACLE_SQL["wholesale_daily_summary"] = W_CTE + """
SELECT LOCATIONNAME, TRANSACTIONDATE, MATCHED_SNOP_CATEGORY,
       round(coalesce(sum(UNIT_COUNT), 0.0), 2) AS UNIT_COUNT, round(coalesce(sum(TOTAL_REVENUE), 0.0), 2) AS TOTAL_REVENUE
FROM w_lab WHERE MATCHED_SNOP_CATEGORY IS NOT NULL
GROUP BY LOCATIONNAME, TRANSACTIONDATE, MATCHED_SNOP_CATEGORY"""

ORACLE_SQL["wholesale_category_summary"] = W_CTE + """
SELECT 'Wholesale' AS LOCATIONNAME, MATCHED_SNOP_CATEGORY, PRODUCTNAME,
       round(coalesce(sum(UNIT_COUNT), 0.0), 2) AS UNIT_COUNT, round(coalesce(sum(TOTAL_REVENUE), 0.0), 2) AS TOTAL_REVENUE
FROM w_lab WHERE MATCHED_SNOP_CATEGORY IS NOT NULL
GROUP BY MATCHED_SNOP_CATEGORY, PRODUCTNAME"""

# --------------------------------------------------------------------------- M2

ORACLE_SQL["retail_extract"] = duckdb_ctes(["retail_sales"]) + f"""
SELECT LOCATIONNAME, PRODUCTID, PRODUCTNAME, SKU, MASTERCATEGORY, BRANDNAME, PRODUCTGRAMS,
       round(sum(PRODUCTGRAMS), 2) AS WEIGHTSOLD, CATEGORY, TRANSACTIONDATE,
       count(DISTINCT TRANSACTIONID) AS TOTAL_TRANSACTIONS, round(sum(QUANTITY), 2) AS TOTAL_QUANTITY,
       round(sum(NETSALEFORITEM), 4) AS TOTAL_REVENUE, round(avg(UNITCOST), 4) AS AVG_UNIT_COST
FROM retail_sales
WHERE lower(TRANSACTIONTYPE) = 'retail' AND TRANSACTIONDATE BETWEEN {AS_OF_R} - 90 AND {AS_OF_R}
  AND MASTERCATEGORY IN ({MASTER}) AND RETURNDATE IS NULL AND lower(ISVOID) = 'false'
GROUP BY LOCATIONNAME, PRODUCTID, PRODUCTNAME, PRODUCTGRAMS, SKU, MASTERCATEGORY, BRANDNAME, CATEGORY, TRANSACTIONDATE"""

ORACLE_SQL["retail_latest_snapshot"] = duckdb_ctes(["retail_inventory"]) + f"""
SELECT * FROM retail_inventory
WHERE INVENTORYDATE = (SELECT max(INVENTORYDATE) FROM retail_inventory)
  AND QUANTITYAVAILABLE IS NOT NULL AND MASTERCATEGORY IN ({MASTER}) AND QUANTITYAVAILABLE > 0"""

_WI_SNAP = """
wi_snap AS (
  SELECT 'Wholesale' AS LOCATIONNAME, PRODUCTNAME, BRAND AS BRANDNAME, PRODUCTSKU, UNITSIZE AS WEIGHTUNIT, UNITSPERCASE,
         INVENTORYDATE, QUANTITY AS QUANTITYONHAND
  FROM wholesale_inventory
  WHERE INVENTORYDATE = (SELECT max(INVENTORYDATE) FROM wholesale_inventory)
    AND QUANTITY IS NOT NULL AND QUANTITY > 0 AND PRODUCTARCHIVED = false)"""

ORACLE_SQL["wholesale_latest_snapshot"] = duckdb_ctes(["wholesale_inventory"]) + "," + _WI_SNAP + """
SELECT * REPLACE (CAST(UNITSPERCASE AS DOUBLE) AS UNITSPERCASE) FROM wi_snap"""

# --------------------------------------------------------------------------- M3

_NAMES = duckdb_ctes(["product"]) + ", names AS (SELECT DISTINCT PRODUCTNAME FROM product)"

ORACLE_SQL["clean_names"] = _NAMES + f"\nSELECT PRODUCTNAME, {clean('PRODUCTNAME')} AS CLEANED FROM names"

ORACLE_SQL["normalize_names"] = duckdb_ctes(["product", "catalog"]) + f"""
, names AS (SELECT PRODUCTNAME FROM product UNION SELECT PRODUCTNAME FROM catalog)
SELECT PRODUCTNAME, {normalize(clean('PRODUCTNAME'))} AS NORMALIZED FROM names"""

ORACLE_SQL["extract_grams"] = _NAMES + f"\nSELECT PRODUCTNAME, {grams('PRODUCTNAME')} AS GRAMS FROM names"

ORACLE_SQL["product_type_sales"] = _NAMES + f"\nSELECT PRODUCTNAME, {type_sales('PRODUCTNAME')} AS PRODUCTTYPE FROM names"

ORACLE_SQL["product_type_inventory"] = duckdb_ctes(["product"]) + f"""
, p AS (SELECT DISTINCT PRODUCTNAME, CATEGORY, MASTERCATEGORY FROM product)
SELECT PRODUCTNAME, CATEGORY, MASTERCATEGORY,
       CASE WHEN {forced()} THEN 'concentrate' ELSE {type_inventory('PRODUCTNAME')} END AS PRODUCTTYPE
FROM p"""

ORACLE_SQL["flavor_tokens"] = _NAMES + f"""
SELECT PRODUCTNAME, {tokens('PRODUCTNAME', False)} AS TOKENS_SALES, {strip(flavor_text('PRODUCTNAME', False))} AS FLAVOR_SALES,
       {tokens('PRODUCTNAME', True)} AS TOKENS_INVENTORY, {strip(flavor_text('PRODUCTNAME', True))} AS FLAVOR_INVENTORY
FROM names"""

ORACLE_SQL["strain_and_pack"] = _NAMES + f"""
SELECT PRODUCTNAME, {strain('PRODUCTNAME')} AS STRAIN, {pack('PRODUCTNAME')} AS PACK FROM names"""

# --------------------------------------------------------------------------- M4

_SALES_KEYS = f"""
s_keys AS (
  SELECT DISTINCT PRODUCTNAME, BRANDNAME FROM retail_sales
  WHERE MASTERCATEGORY IN ({MASTER}) AND {sales_gate()}),
s_emap AS (
  SELECT PRODUCTNAME AS KEY, arg_max(SNOPCATEGORY, CATALOGPOS) AS CAT FROM catalog
  WHERE SNOPCATEGORY IS NOT NULL AND PRODUCTNAME IS NOT NULL GROUP BY PRODUCTNAME)"""

_INV_KEYS = f"""
i_keys AS (
  SELECT DISTINCT PRODUCTNAME, BRANDNAME, {forced()} AS TYPE_FORCED FROM retail_inventory
  WHERE MASTERCATEGORY IN ({MASTER}) AND {inv_gate()}),
i_refs AS (
  SELECT REF_KEY, min(CATALOGPOS) AS REF_POS, arg_max_null(SNOPCATEGORY, CATALOGPOS) AS REF_CAT
  FROM (SELECT {normalize(clean('PRODUCTNAME'))} AS REF_KEY, SNOPCATEGORY, CATALOGPOS FROM catalog) c
  GROUP BY REF_KEY)"""

ORACLE_SQL["brand_gate"] = duckdb_ctes(["retail_sales"]) + f"""
SELECT BRANDNAME, coalesce({sales_gate()}, false) AS APPROVED, count(*) AS ROWS
FROM retail_sales WHERE MASTERCATEGORY IN ({MASTER})
GROUP BY BRANDNAME, APPROVED"""

ORACLE_SQL["exact_match"] = duckdb_ctes(["retail_sales", "catalog"]) + "," + _SALES_KEYS + """
SELECT k.PRODUCTNAME, k.BRANDNAME, e.CAT AS MATCHED_SNOP_CATEGORY, CAST(100 AS DOUBLE) AS MATCH_SCORE,
       k.PRODUCTNAME AS MATCHED_REFERENCE, 'Matched (Exact Match)' AS MATCH_RESULT
FROM s_keys k JOIN s_emap e ON k.PRODUCTNAME = e.KEY"""

ORACLE_SQL["exact_match_brand"] = duckdb_ctes(["retail_sales", "catalog"]) + "," + _SALES_KEYS + f"""
, alt AS (SELECT PRODUCTNAME, BRANDNAME,
     {strip("concat(coalesce(PRODUCTNAME, ''), ' - ', coalesce(BRANDNAME, 'None'))")} AS ALT_KEY FROM s_keys)
SELECT a.PRODUCTNAME, a.BRANDNAME, e.CAT AS MATCHED_SNOP_CATEGORY, CAST(99 AS DOUBLE) AS MATCH_SCORE,
       a.ALT_KEY AS MATCHED_REFERENCE, 'Matched (Exact Match w/ Brand)' AS MATCH_RESULT
FROM alt a JOIN s_emap e ON a.ALT_KEY = e.KEY"""

ORACLE_SQL["token_key_match"] = duckdb_ctes(["retail_inventory", "catalog"]) + "," + _INV_KEYS + f"""
, k AS (SELECT *, {token_key(normalize(clean('PRODUCTNAME')))} AS TK FROM i_keys),
r AS (SELECT *, {token_key('REF_KEY')} AS RTK FROM i_refs),
hits AS (SELECT k.PRODUCTNAME, k.BRANDNAME, k.TYPE_FORCED, arg_min_null(r.REF_CAT, r.REF_POS) AS CAT,
                arg_min(r.REF_KEY, r.REF_POS) AS REF
         FROM k JOIN r ON k.TK = r.RTK GROUP BY k.PRODUCTNAME, k.BRANDNAME, k.TYPE_FORCED)
SELECT PRODUCTNAME, BRANDNAME, CAT AS MATCHED_SNOP_CATEGORY, CAST(100 AS DOUBLE) AS MATCH_SCORE,
       REF AS MATCHED_REFERENCE, 'High-Confidence Override' AS MATCH_RESULT
FROM hits"""

# --------------------------------------------------------------------------- M6

ORACLE_SQL["preroll_fallback"] = duckdb_ctes(["retail_sales", "catalog"]) + "," + _SALES_KEYS + f"""
, cand AS (
  SELECT PRODUCTNAME, BRANDNAME, lower(coalesce(BRANDNAME, 'None')) AS B, {strain('PRODUCTNAME')} AS S,
         TRY_CAST({pack('PRODUCTNAME')} AS DECIMAL(38, 0)) AS P, {grams('PRODUCTNAME')} AS G
  FROM s_keys
  WHERE {type_sales('PRODUCTNAME')} = 'flower' AND contains({clean('PRODUCTNAME')}, 'preroll')
    AND contains(lower(coalesce(PRODUCTNAME, '')), 'preroll')),
fb AS (
  SELECT PRODUCTNAME AS FB_NAME, SNOPCATEGORY AS FB_CAT, CATALOGPOS AS FB_POS,
         lower(coalesce(CAST(BRAND AS VARCHAR), 'None')) AS B, {strain('lower(PRODUCTNAME)')} AS S,
         TRY_CAST({pack('PRODUCTNAME')} AS DECIMAL(38, 0)) AS P, {grams('lower(PRODUCTNAME)')} AS G
  FROM catalog WHERE contains(lower(coalesce(PRODUCTNAME, 'None')), 'preroll'))
SELECT c.PRODUCTNAME, c.BRANDNAME, arg_min_null(f.FB_CAT, f.FB_POS) AS MATCHED_SNOP_CATEGORY,
       CAST(90 AS DOUBLE) AS MATCH_SCORE, arg_min(f.FB_NAME, f.FB_POS) AS MATCHED_REFERENCE,
       'Fallback Preroll Match' AS MATCH_RESULT
FROM cand c JOIN fb f ON c.B = f.B AND c.S IS NOT DISTINCT FROM f.S AND c.P IS NOT DISTINCT FROM f.P
WHERE c.G <> 0 AND f.G <> 0 AND abs(c.G - f.G) < 0.05
GROUP BY c.PRODUCTNAME, c.BRANDNAME"""

ORACLE_SQL["bulk_override"] = duckdb_ctes(["retail_sales", "retail_inventory", "catalog"]) + "," + _SALES_KEYS + "," + _INV_KEYS + """
, k AS (
  SELECT 'fixture_sales' AS PRESET, PRODUCTNAME, BRANDNAME, false AS TYPE_FORCED,
         contains(lower(coalesce(BRANDNAME, 'None')), 'brand#1') OR contains(lower(coalesce(PRODUCTNAME, '')), 'brand#1') AS PREMIUM
  FROM s_keys
  UNION ALL
  SELECT 'fixture_inventory', PRODUCTNAME, BRANDNAME, TYPE_FORCED, contains(lower(coalesce(BRANDNAME, 'None')), 'brand#1')
  FROM i_keys)
SELECT PRESET, PRODUCTNAME, BRANDNAME, TYPE_FORCED,
       CASE WHEN PREMIUM THEN 'NEA Fire Bulk Flower g' ELSE 'NEA Bulk Flower g' END AS MATCHED_SNOP_CATEGORY,
       CASE WHEN PREMIUM THEN CAST(100 AS DOUBLE) ELSE CAST(95 AS DOUBLE) END AS MATCH_SCORE,
       CASE WHEN PREMIUM THEN 'bulk name brand rule' ELSE 'bulk name rule' END AS MATCHED_REFERENCE,
       'Bulk Override' AS MATCH_RESULT
FROM k WHERE contains(lower(coalesce(PRODUCTNAME, '')), 'bulk')"""

ORACLE_SQL["trim_bulk_override"] = duckdb_ctes(["wholesale_inventory"]) + "," + _WI_SNAP + f"""
, conv AS (
  SELECT *,
    CASE WHEN contains(upper(coalesce(PRODUCTNAME, '')), 'BULK') OR contains(upper(coalesce(PRODUCTNAME, '')), 'TRIM')
           THEN coalesce(QUANTITYONHAND, 0.0) * 453.6
         WHEN coalesce(nullif(CAST(UNITSPERCASE AS DOUBLE), 0), 1.0) <> 1.0
           THEN coalesce(QUANTITYONHAND, 0.0) * coalesce(nullif(CAST(UNITSPERCASE AS DOUBLE), 0), 1.0)
         ELSE coalesce(QUANTITYONHAND, 0.0) END AS TOTAL_QUANTITY,
    PRODUCTSKU IS NULL OR {strip('PRODUCTSKU')} = '' AS MISSING,
    contains(upper(coalesce(PRODUCTNAME, 'None')), 'TRIM') AS IS_TRIM,
    contains(upper(coalesce(PRODUCTNAME, 'None')), 'BULK') AS IS_BULK,
    contains(upper(coalesce(BRANDNAME, 'None')), 'BRAND#1') OR contains(upper(coalesce(PRODUCTNAME, 'None')), 'BRAND#1') AS PREMIUM
  FROM wi_snap),
lab AS (
  SELECT *, MISSING AND (IS_TRIM OR IS_BULK) AS HIT, CASE WHEN IS_TRIM THEN 'trim' ELSE 'bulk' END AS KIND FROM conv)
SELECT LOCATIONNAME, INVENTORYDATE,
  CASE WHEN HIT AND PREMIUM THEN 'NEA Fire Bulk Flower g' WHEN HIT THEN 'NEA Bulk Flower g' ELSE PRODUCTSKU END AS MATCHED_SNOP_CATEGORY,
  PRODUCTNAME, round(TOTAL_QUANTITY, 2) AS TOTAL_QUANTITY,
  CASE WHEN HIT AND IS_TRIM THEN 'Trim Override' WHEN HIT THEN 'Bulk Override'
       WHEN PRODUCTSKU IS NOT NULL THEN 'Matched (wholesale clean)' ELSE 'Missing SKU' END AS MATCH_RESULT,
  CASE WHEN HIT AND PREMIUM THEN CAST(95 AS DOUBLE) WHEN HIT THEN CAST(90 AS DOUBLE)
       WHEN PRODUCTSKU IS NOT NULL THEN CAST(100 AS DOUBLE) END AS MATCH_SCORE,
  CASE WHEN HIT AND PREMIUM THEN KIND || ' name brand rule' WHEN HIT THEN KIND || ' name rule'
       WHEN PRODUCTSKU IS NOT NULL THEN 'wholesale direct' END AS MATCHED_REFERENCE,
  BRANDNAME
FROM lab"""

# --------------------------------------------------------------------------- M5

# LCS by dynamic programming in SQL: one recursion step per character of A,
# each step builds the next DP row with list_reduce (row[j+1] = LCS(A[:i], B[:j])).
_LCS = """
lcs(pid, i, r) AS (
  SELECT pid, 0, list_transform(range(length(B) + 1), lambda x: 0) FROM pairs
  UNION ALL
  SELECT l.pid, l.i + 1,
         list_reduce(range(1, length(p.B) + 1),
                     lambda acc, j: list_append(acc, CASE WHEN substr(p.A, l.i + 1, 1) = substr(p.B, j, 1)
                                                          THEN l.r[j] + 1 ELSE greatest(l.r[j + 1], acc[j]) END),
                     [0])
  FROM lcs l JOIN pairs p ON l.pid = p.pid
  WHERE l.i < length(p.A)),
scored AS (
  SELECT p.*, CASE WHEN length(p.A) + length(p.B) = 0 THEN CAST(100 AS DOUBLE)
                   ELSE (1.0 - CAST(length(p.A) + length(p.B) - 2 * l.r[-1] AS DOUBLE) / (length(p.A) + length(p.B))) * 100.0
              END AS SCORE
  FROM pairs p JOIN lcs l ON l.pid = p.pid AND l.i = length(p.A))"""

ORACLE_SQL["fuzzy_top5"] = "WITH RECURSIVE" + duckdb_ctes(["retail_sales", "catalog"])[len("WITH"):] + "," + _SALES_KEYS + f"""
, texts AS (SELECT DISTINCT {token_key(clean('PRODUCTNAME'))} AS A FROM s_keys),
refs AS (SELECT lower(PRODUCTNAME) AS REF_KEY, min(CATALOGPOS) AS REF_POS FROM catalog
         WHERE PRODUCTNAME IS NOT NULL GROUP BY lower(PRODUCTNAME)),
rt AS (SELECT REF_KEY, REF_POS, {token_key('REF_KEY')} AS B FROM refs),
pairs AS (
  SELECT row_number() OVER () AS pid, t.A, r.B, r.REF_KEY, r.REF_POS
  FROM texts t JOIN rt r
    ON 5 * least(length(t.A), length(r.B)) >= 3 * greatest(length(t.A), length(r.B))),
{_LCS},
ranked AS (
  SELECT A, REF_KEY, SCORE, row_number() OVER (PARTITION BY A ORDER BY SCORE DESC, REF_POS ASC) AS RANK
  FROM scored)
SELECT A AS TOKEN_KEY, REF_KEY, round(SCORE, 4) AS SCORE, CAST(RANK AS BIGINT) AS RANK
FROM ranked WHERE RANK <= 5 AND SCORE >= 75"""

# --------------------------------------------------------------------------- M4 (inventory exceptions)

_CP1252 = []
for _b in range(0x80, 0xA0):
    try:
        _CP1252.append((bytes([_b]).decode("cp1252"), chr(_b)))
    except UnicodeDecodeError:
        pass
_CP_FROM = "".join(a for a, _ in _CP1252)
_CP_TO = "".join(b for _, b in _CP1252)


def _redecode(x: str) -> str:
    """Bytes of the code points (all <= 0xFF) read back as UTF-8; NULL when invalid."""
    hexes = f"array_to_string(list_transform(string_split({x}, ''), lambda ch: lpad(to_hex(unicode(ch)), 2, '0')), '')"
    return f"try(decode(unhex({hexes})))"


def _latin1(x: str) -> str:
    return rf"CASE WHEN regexp_full_match({x}, '[\x00-\xFF]*') THEN {_redecode(x)} END"


def _cp1252(x: str) -> str:
    t = f"translate({x}, '{_CP_FROM}', '{_CP_TO}')"
    return rf"CASE WHEN regexp_full_match({x}, '[\x00-\x7F\xA0-\xFF{_CP_FROM}]*') THEN {_redecode(t)} END"


def _fixes(x: str) -> list:
    out = []
    for bad, good in (("Ã©", "é"), ("ã©", "é"), ("Ã±", "ñ"), ("ã±", "ñ"), ("Ã¼", "ü"), ("ã¼", "ü")):
        out.append(f"CASE WHEN contains({x}, '{bad}') THEN replace({x}, '{bad}', '{good}') END")
    out.append(_latin1(x))
    out.append(_cp1252(x))
    return out


def _variants() -> str:
    parts = []
    for i, fx in enumerate(_fixes("coalesce(PRODUCTNAME, '')")):
        parts.append(f"SELECT PRODUCTNAME, BRANDNAME, TYPE_FORCED, {2 * i} AS PRIO, {fx} AS S FROM nonascii")
        parts.append(f"SELECT PRODUCTNAME, BRANDNAME, TYPE_FORCED, {2 * i + 1} AS PRIO, "
                     f"({fx}) || ' - ' || coalesce(BRANDNAME, 'None') AS S FROM nonascii")
    return "\nUNION ALL ".join(parts)


def exception_ctes(keys: str) -> str:
    """CTEs ending in ``exc_hits(PRODUCTNAME, BRANDNAME, TYPE_FORCED, CAT, XKEY)``; needs ``i_refs``."""
    return f"""
nonascii AS (SELECT * FROM {keys} WHERE regexp_matches(coalesce(PRODUCTNAME, ''), '[^\x00-\x7F]')),
variants AS ({_variants()}),
xkeys AS (SELECT PRODUCTNAME, BRANDNAME, TYPE_FORCED, PRIO, {normalize(clean('S'))} AS XKEY FROM variants WHERE S IS NOT NULL),
exc_hits AS (
  SELECT x.PRODUCTNAME, x.BRANDNAME, x.TYPE_FORCED, arg_min_null(r.REF_CAT, x.PRIO) AS CAT, arg_min(x.XKEY, x.PRIO) AS XKEY
  FROM xkeys x JOIN i_refs r ON x.XKEY = r.REF_KEY
  WHERE x.XKEY <> ''
  GROUP BY x.PRODUCTNAME, x.BRANDNAME, x.TYPE_FORCED)"""


ORACLE_SQL["name_exception_match"] = duckdb_ctes(["retail_inventory", "catalog"]) + "," + _INV_KEYS + "," + exception_ctes("i_keys") + """
SELECT PRODUCTNAME, BRANDNAME, CAT AS MATCHED_SNOP_CATEGORY, CAST(100 AS DOUBLE) AS MATCH_SCORE,
       XKEY AS MATCHED_REFERENCE, 'Matched (Exact Match – Name Exception)' AS MATCH_RESULT
FROM exc_hits"""


# --------------------------------------------------------------------------- M7 (control totals)

# Totals add the unrounded converted quantities; only the sums are rounded.
ORACLE_SQL["control_totals"] = ORACLE_SQL["trim_bulk_override"].replace(
    """SELECT LOCATIONNAME, INVENTORYDATE,""", """, final AS (SELECT LOCATIONNAME, INVENTORYDATE, QUANTITYONHAND,""", 1).replace(
    "round(TOTAL_QUANTITY, 2) AS TOTAL_QUANTITY", "TOTAL_QUANTITY AS TOTAL_QUANTITY", 1) + """)
SELECT count(*) AS ROWS, round(coalesce(sum(QUANTITYONHAND), 0.0), 2) AS QUANTITY_BEFORE,
       round(coalesce(sum(TOTAL_QUANTITY), 0.0), 2) AS QUANTITY_AFTER,
       CAST(sum(CASE WHEN contains(upper(coalesce(PRODUCTNAME, '')), 'TRIM') THEN 1 ELSE 0 END) AS BIGINT) AS TRIM_ROWS,
       CAST(sum(CASE WHEN MATCH_RESULT IN ('Trim Override', 'Bulk Override') THEN 1 ELSE 0 END) AS BIGINT) AS OVERRIDES,
       CAST(sum(CASE WHEN MATCHED_SNOP_CATEGORY IS NULL OR trim(MATCHED_SNOP_CATEGORY) = '' THEN 1 ELSE 0 END) AS BIGINT) AS UNMATCHED_ROWS,
       CAST(sum(CASE WHEN TOTAL_QUANTITY IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS NULL_TOTAL_QUANTITY
FROM final"""

# --------------------------------------------------------------------------- M6 (strict tier)


def lcs_ctes(p: str, pairs: str) -> str:
    """``{p}lcs`` (recursive DP) and ``{p}scored`` (ratio) over a table ``pairs(pid, A, B)``."""
    return f"""
{p}lcs(pid, i, r) AS (
  SELECT pid, 0, list_transform(range(length(B) + 1), lambda x: 0) FROM {pairs}
  UNION ALL
  SELECT l.pid, l.i + 1,
         list_reduce(range(1, length(q.B) + 1),
                     lambda acc, j: list_append(acc, CASE WHEN substr(q.A, l.i + 1, 1) = substr(q.B, j, 1)
                                                          THEN l.r[j] + 1 ELSE greatest(l.r[j + 1], acc[j]) END),
                     [0])
  FROM {p}lcs l JOIN {pairs} q ON l.pid = q.pid
  WHERE l.i < length(q.A)),
{p}scored AS (
  SELECT q.*, CASE WHEN length(q.A) + length(q.B) = 0 THEN CAST(100 AS DOUBLE)
                   ELSE (1.0 - CAST(length(q.A) + length(q.B) - 2 * l.r[-1] AS DOUBLE) / (length(q.A) + length(q.B))) * 100.0
              END AS SCORE
  FROM {pairs} q JOIN {p}lcs l ON l.pid = q.pid AND l.i = length(q.A))"""


def _flavor_list(x: str) -> str:
    return rf"list_filter(string_split_regex({flavor_text(x, False)}, '\s+'), lambda w: length(w) >= 3)"


_MC = "lower(coalesce(REF_CAT, 'None'))"
_MS = strain("REF_CAT")
_PASS = f"""(
  coalesce((P_GRAMS = 0 OR REF_GRAMS = 0) OR NOT coalesce(P_TYPE IN ('flower', 'concentrate', 'vape', 'preroll'), false)
           OR (P_GRAMS IS NOT NULL AND REF_GRAMS IS NOT NULL
               AND NOT ((P_GRAMS > 7 AND REF_GRAMS <= 3.5) OR (REF_GRAMS > 7 AND P_GRAMS <= 3.5))
               AND abs(P_GRAMS - REF_GRAMS) <= 0.05), false)
  AND (coalesce(P_TYPE, '') <> 'edible'
       OR coalesce(len(REF_FLAVORS) > 0 AND (len(list_intersect(P_FLAVORS, REF_FLAVORS)) >= 2 OR FSCORE >= 85), false))
  AND NOT ((contains(NAME_LC, 'pr') OR contains(NAME_LC, 'preroll'))
           AND (contains({_MC}, 'concentrate') OR contains({_MC}, 'vape')))
  AND contains(NAME_LC, 'infused') = contains({_MC}, 'infused')
  AND coalesce(P_STRAIN IS NULL OR {_MS} IS NULL OR P_STRAIN = {_MS}, true)
  AND NOT ({any_of('NAME_LC', ('preground', '7g', 'bulk', 'ounce'))} AND contains({_MC}, 'preroll'))
  AND coalesce(BRANDNAME IS NULL OR BRANDNAME = '' OR REF_CAT IS NULL OR REF_CAT = ''
               OR NOT ({' OR '.join(f"(lower({strip('BRANDNAME')}) = 'brand#{i}' AND NOT contains(lower(REF_CAT), 'brand#{i}'))" for i in range(1, 5))}), true)
  AND coalesce(NOT coalesce(P_TYPE = 'flower', false)
               OR CASE WHEN P_STRAIN IS NOT NULL AND {_MS} IS NOT NULL THEN P_STRAIN = {_MS} ELSE false END, false)
  AND SCORE >= 75)"""

def strict_ctes(keys: str) -> str:
    """CTEs ending in ``best``: BR = 1 marks the strict match of each key of table ``keys``."""
    return f"""
feats AS (
  SELECT PRODUCTNAME, BRANDNAME, {clean('PRODUCTNAME')} AS CLEANED, {token_key(clean('PRODUCTNAME'))} AS TK,
         lower(coalesce(PRODUCTNAME, '')) AS NAME_LC, {type_sales('PRODUCTNAME')} AS P_TYPE,
         {grams('PRODUCTNAME')} AS P_GRAMS, {strain('PRODUCTNAME')} AS P_STRAIN,
         {_flavor_list('PRODUCTNAME')} AS P_FLAVORS, {strip(flavor_text('PRODUCTNAME', False))} AS P_FLAVOR_STR
  FROM {keys}),
refs AS (SELECT lower(PRODUCTNAME) AS REF_KEY, min(CATALOGPOS) AS REF_POS, arg_max_null(SNOPCATEGORY, CATALOGPOS) AS REF_CAT
         FROM catalog WHERE PRODUCTNAME IS NOT NULL GROUP BY lower(PRODUCTNAME)),
rt AS (SELECT *, {token_key('REF_KEY')} AS RTK, {grams('REF_KEY')} AS REF_GRAMS, {_flavor_list('REF_KEY')} AS REF_FLAVORS,
              {strip(flavor_text('REF_KEY', False))} AS REF_FLAVOR_STR FROM refs),
texts AS (SELECT DISTINCT TK FROM feats),
pairs AS (
  SELECT row_number() OVER () AS pid, t.TK AS A, r.RTK AS B, r.REF_KEY, r.REF_POS
  FROM texts t JOIN rt r ON 5 * least(length(t.TK), length(r.RTK)) >= 3 * greatest(length(t.TK), length(r.RTK))),
{lcs_ctes('', 'pairs')},
ranked AS (SELECT A, REF_KEY, SCORE, REF_POS, row_number() OVER (PARTITION BY A ORDER BY SCORE DESC, REF_POS ASC) AS RK FROM scored),
cand AS (
  SELECT f.*, k.REF_KEY, k.SCORE, k.REF_POS, r.REF_CAT, r.REF_GRAMS, r.REF_FLAVORS, r.REF_FLAVOR_STR
  FROM feats f JOIN ranked k ON f.TK = k.A AND k.RK <= 5 JOIN rt r ON r.REF_KEY = k.REF_KEY),
fpairs AS (SELECT row_number() OVER () AS pid, A, B FROM
           (SELECT DISTINCT P_FLAVOR_STR AS A, REF_FLAVOR_STR AS B FROM cand WHERE P_TYPE = 'edible')),
{lcs_ctes('f', 'fpairs')},
judged AS (
  SELECT c.*, fs.SCORE AS FSCORE FROM cand c
  LEFT JOIN fscored fs ON fs.A = c.P_FLAVOR_STR AND fs.B = c.REF_FLAVOR_STR),
valid AS (SELECT * EXCLUDE (FSCORE) FROM judged WHERE {_PASS}),
pp AS (SELECT DISTINCT REF_KEY AS X, CLEANED AS Y FROM valid),
dirs AS (
  SELECT X, Y, CASE WHEN length(X) <= length(Y) THEN X ELSE Y END AS S, CASE WHEN length(X) <= length(Y) THEN Y ELSE X END AS L FROM pp
  UNION ALL
  SELECT X, Y, Y AS S, X AS L FROM pp WHERE length(X) = length(Y)),
windows AS (
  SELECT X, Y, S, substr(L, 1, i) AS W FROM (SELECT *, unnest(range(1, length(S))) AS i FROM dirs)
  UNION ALL
  SELECT X, Y, S, substr(L, k + 1, length(S)) FROM (SELECT *, unnest(range(0, length(L) - length(S) + 1)) AS k FROM dirs)
  UNION ALL
  SELECT X, Y, S, substr(L, k + 1) FROM (SELECT *, unnest(range(length(L) - length(S) + 1, length(L))) AS k FROM dirs)),
wpairs AS (SELECT row_number() OVER () AS pid, A, B FROM (SELECT DISTINCT S AS A, W AS B FROM windows WHERE S <> '')),
{lcs_ctes('w', 'wpairs')},
partial AS (
  SELECT w.X, w.Y, max(ws.SCORE) AS P FROM windows w JOIN wscored ws ON ws.A = w.S AND ws.B = w.W GROUP BY w.X, w.Y),
best AS (
  SELECT v.*, row_number() OVER (PARTITION BY v.PRODUCTNAME, v.BRANDNAME
                                 ORDER BY v.SCORE DESC, coalesce(p.P, 0) DESC, v.REF_POS ASC) AS BR
  FROM valid v LEFT JOIN partial p ON p.X = v.REF_KEY AND p.Y = v.CLEANED)"""


ORACLE_SQL["strict_match"] = ("WITH RECURSIVE" + duckdb_ctes(["retail_sales", "catalog"])[len("WITH"):] + ","
                              + _SALES_KEYS + ",\n" + strict_ctes("s_keys") + """
SELECT PRODUCTNAME, BRANDNAME, REF_CAT AS MATCHED_SNOP_CATEGORY, round(SCORE, 4) AS MATCH_SCORE,
       REF_KEY AS MATCHED_REFERENCE, 'Matched (Strict Rules)' AS MATCH_RESULT
FROM best WHERE BR = 1""")

# --------------------------------------------------------------------------- M5 (partial ratio backup)


def lcs_final_rows(p: str, pairs: str) -> str:
    """``{p}lcs`` DP and ``{p}fin(pid, A, B, R)`` with the final DP row R (R[k+1] = LCS(A, B[:k]))."""
    return f"""
{p}lcs(pid, i, r) AS (
  SELECT pid, 0, list_transform(range(length(B) + 1), lambda x: 0) FROM {pairs}
  UNION ALL
  SELECT l.pid, l.i + 1,
         list_reduce(range(1, length(q.B) + 1),
                     lambda acc, j: list_append(acc, CASE WHEN substr(q.A, l.i + 1, 1) = substr(q.B, j, 1)
                                                          THEN l.r[j] + 1 ELSE greatest(l.r[j + 1], acc[j]) END),
                     [0])
  FROM {p}lcs l JOIN {pairs} q ON l.pid = q.pid
  WHERE l.i < length(q.A)),
{p}fin AS (SELECT q.*, l.r AS R FROM {pairs} q JOIN {p}lcs l ON l.pid = q.pid AND l.i = length(q.A))"""


def _win_ratio(ls: str, lw: str, lcs: str) -> str:
    return f"(1.0 - CAST({ls} + {lw} - 2 * {lcs} AS DOUBLE) / ({ls} + {lw})) * 100.0"


# partial_ratio(X, C) for every row of a table ``pr_in(X, C)``
_PARTIAL = f"""
pr_dirs AS (
  SELECT X, C, CASE WHEN length(X) <= length(C) THEN X ELSE C END AS S, CASE WHEN length(X) <= length(C) THEN C ELSE X END AS L
  FROM pr_in
  UNION ALL
  SELECT X, C, C AS S, X AS L FROM pr_in WHERE length(X) = length(C)),
pr_pre AS (SELECT row_number() OVER () AS pid, S, L, S AS A, substr(L, 1, length(S) - 1) AS B FROM pr_dirs WHERE S <> ''),
pr_suf AS (SELECT row_number() OVER () AS pid, S, L, reverse(S) AS A, reverse(substr(L, length(L) - length(S) + 2)) AS B
           FROM pr_dirs WHERE S <> ''),
pr_full AS (SELECT row_number() OVER () AS pid, S, L, S AS A, substr(L, k + 1, length(S)) AS B
            FROM (SELECT *, unnest(range(0, length(L) - length(S) + 1)) AS k FROM pr_dirs WHERE S <> '')),
{lcs_final_rows('pre', 'pr_pre')},
{lcs_final_rows('suf', 'pr_suf')},
{lcs_final_rows('ful', 'pr_full')},
pr_scores AS (
  SELECT S, L, list_max(list_transform(range(1, length(B) + 1), lambda k: {_win_ratio('length(A)', 'k', 'R[k + 1]')})) AS V FROM prefin
  UNION ALL
  SELECT S, L, list_max(list_transform(range(1, length(B) + 1), lambda k: {_win_ratio('length(A)', 'k', 'R[k + 1]')})) FROM suffin
  UNION ALL
  SELECT S, L, {_win_ratio('length(A)', 'length(B)', 'R[-1]')} FROM fulfin),
pr_out AS (
  SELECT i.X, i.C,
         CASE WHEN i.X = '' AND i.C = '' THEN CAST(100 AS DOUBLE) ELSE coalesce(max(s.V), CAST(0 AS DOUBLE)) END AS P
  FROM pr_in i
  LEFT JOIN pr_dirs d ON d.X = i.X AND d.C = i.C
  LEFT JOIN pr_scores s ON s.S = d.S AND s.L = d.L
  GROUP BY i.X, i.C)"""

def backup_ctes(keys: str) -> str:
    """CTEs ending in ``bk_best``: RN = 1 is the best lower-cased category per cleaned edible name."""
    return f"""
ed AS (SELECT PRODUCTNAME, BRANDNAME, {clean('PRODUCTNAME')} AS X FROM {keys} WHERE {type_sales('PRODUCTNAME')} = 'edible'),
cats AS (SELECT lower(SNOPCATEGORY) AS C, min(CATALOGPOS) AS CPOS FROM catalog WHERE SNOPCATEGORY IS NOT NULL GROUP BY lower(SNOPCATEGORY)),
pr_in AS (SELECT DISTINCT e.X, c.C FROM (SELECT DISTINCT X FROM ed) e, cats c),
{_PARTIAL},
bk_best AS (
  SELECT o.X, o.C, o.P, row_number() OVER (PARTITION BY o.X ORDER BY o.P DESC, c.CPOS ASC) AS RN
  FROM pr_out o JOIN cats c ON c.C = o.C)"""


ORACLE_SQL["partial_best"] = ("WITH RECURSIVE" + duckdb_ctes(["retail_sales", "catalog"])[len("WITH"):] + ","
                              + _SALES_KEYS + ",\n" + backup_ctes("s_keys") + """
SELECT e.PRODUCTNAME, e.BRANDNAME, b.C AS MATCHED_SNOP_CATEGORY, round(b.P, 4) AS MATCH_SCORE, b.C AS MATCHED_REFERENCE,
       'Backup S&OP Match' AS MATCH_RESULT
FROM ed e JOIN bk_best b ON b.X = e.X AND b.RN = 1
WHERE b.P >= 70""")
ORACLE_SQL["edible_backup"] = ORACLE_SQL["partial_best"]

# --------------------------------------------------------------------------- sales ladder and reports

_S_ROWS = f"""
s_rows AS (
  SELECT *, {sales_gate()} AS APPROVED FROM retail_sales
  WHERE lower(TRANSACTIONTYPE) = 'retail' AND TRANSACTIONDATE BETWEEN {AS_OF_R} - 90 AND {AS_OF_R}
    AND MASTERCATEGORY IN ({MASTER}) AND RETURNDATE IS NULL AND lower(ISVOID) = 'false'),
s_ext AS (
  SELECT LOCATIONNAME, PRODUCTID, PRODUCTNAME, SKU, MASTERCATEGORY, BRANDNAME, PRODUCTGRAMS,
         sum(PRODUCTGRAMS) AS WEIGHTSOLD, CATEGORY, TRANSACTIONDATE, count(DISTINCT TRANSACTIONID) AS TOTAL_TRANSACTIONS,
         sum(QUANTITY) AS TOTAL_QUANTITY, sum(NETSALEFORITEM) AS TOTAL_REVENUE, avg(UNITCOST) AS AVG_UNIT_COST,
         coalesce(bool_or(APPROVED), false) AS APPROVED
  FROM s_rows
  GROUP BY LOCATIONNAME, PRODUCTID, PRODUCTNAME, PRODUCTGRAMS, SKU, MASTERCATEGORY, BRANDNAME, CATEGORY, TRANSACTIONDATE),
w_keys AS (SELECT DISTINCT PRODUCTNAME, BRANDNAME FROM s_ext WHERE APPROVED),
s_emap AS (
  SELECT PRODUCTNAME AS KEY, arg_max(SNOPCATEGORY, CATALOGPOS) AS CAT FROM catalog
  WHERE SNOPCATEGORY IS NOT NULL AND PRODUCTNAME IS NOT NULL GROUP BY PRODUCTNAME)"""

_LADDER = f"""
lk AS (
  SELECT PRODUCTNAME, BRANDNAME, lower(coalesce(PRODUCTNAME, '')) AS L_NAME, lower(coalesce(BRANDNAME, 'None')) AS L_BRAND,
         {type_sales('PRODUCTNAME')} AS L_TYPE, {clean('PRODUCTNAME')} AS L_CLEAN,
         {strip("concat(coalesce(PRODUCTNAME, ''), ' - ', coalesce(BRANDNAME, 'None'))")} AS ALT_KEY,
         {strain('PRODUCTNAME')} AS L_STRAIN, TRY_CAST({pack('PRODUCTNAME')} AS DECIMAL(38, 0)) AS L_PACK,
         {grams('PRODUCTNAME')} AS L_GRAMS
  FROM w_keys),
fbrows AS (
  SELECT PRODUCTNAME AS FB_NAME, SNOPCATEGORY AS FB_CAT, CATALOGPOS AS FB_POS,
         lower(coalesce(CAST(BRAND AS VARCHAR), 'None')) AS B, {strain('lower(PRODUCTNAME)')} AS S,
         TRY_CAST({pack('PRODUCTNAME')} AS DECIMAL(38, 0)) AS P, {grams('lower(PRODUCTNAME)')} AS G
  FROM catalog WHERE contains(lower(coalesce(PRODUCTNAME, 'None')), 'preroll')),
fb AS (
  SELECT k.PRODUCTNAME, k.BRANDNAME, arg_min_null(f.FB_CAT, f.FB_POS) AS FB_CAT, arg_min(f.FB_NAME, f.FB_POS) AS FB_NAME
  FROM lk k JOIN fbrows f ON k.L_BRAND = f.B AND k.L_STRAIN IS NOT DISTINCT FROM f.S AND k.L_PACK IS NOT DISTINCT FROM f.P
  WHERE k.L_TYPE = 'flower' AND contains(k.L_CLEAN, 'preroll') AND contains(k.L_NAME, 'preroll')
    AND k.L_GRAMS <> 0 AND f.G <> 0 AND abs(k.L_GRAMS - f.G) < 0.05
  GROUP BY k.PRODUCTNAME, k.BRANDNAME),
bk AS (SELECT e.PRODUCTNAME, e.BRANDNAME, b.C, b.P FROM ed e JOIN bk_best b ON b.X = e.X AND b.RN = 1 WHERE b.P >= 70),
st AS (SELECT PRODUCTNAME, BRANDNAME, REF_CAT, SCORE, REF_KEY FROM best WHERE BR = 1),
chain AS (
  SELECT k.*, e1.KEY IS NOT NULL OR e2.KEY IS NOT NULL AS EXACT_HIT,
    CASE WHEN e1.KEY IS NOT NULL THEN e1.CAT WHEN e2.KEY IS NOT NULL THEN e2.CAT
         WHEN st.PRODUCTNAME IS NOT NULL THEN st.REF_CAT WHEN bk.PRODUCTNAME IS NOT NULL THEN bk.C END AS C_CAT,
    CASE WHEN e1.KEY IS NOT NULL THEN CAST(100 AS DOUBLE) WHEN e2.KEY IS NOT NULL THEN CAST(99 AS DOUBLE)
         WHEN st.PRODUCTNAME IS NOT NULL THEN st.SCORE WHEN bk.PRODUCTNAME IS NOT NULL THEN bk.P END AS C_SCORE,
    CASE WHEN e1.KEY IS NOT NULL THEN k.PRODUCTNAME WHEN e2.KEY IS NOT NULL THEN k.ALT_KEY
         WHEN st.PRODUCTNAME IS NOT NULL THEN st.REF_KEY WHEN bk.PRODUCTNAME IS NOT NULL THEN bk.C END AS C_REF,
    CASE WHEN e1.KEY IS NOT NULL THEN 'Matched (Exact Match)' WHEN e2.KEY IS NOT NULL THEN 'Matched (Exact Match w/ Brand)'
         WHEN st.PRODUCTNAME IS NOT NULL THEN 'Matched (Strict Rules)' WHEN bk.PRODUCTNAME IS NOT NULL THEN 'Backup S&OP Match'
         ELSE 'No Acceptable Match' END AS C_LABEL,
    fb.PRODUCTNAME IS NOT NULL AS FB_HIT, fb.FB_CAT, fb.FB_NAME
  FROM lk k
  LEFT JOIN s_emap e1 ON e1.KEY = k.PRODUCTNAME
  LEFT JOIN s_emap e2 ON e2.KEY = k.ALT_KEY
  LEFT JOIN st ON st.PRODUCTNAME IS NOT DISTINCT FROM k.PRODUCTNAME AND st.BRANDNAME IS NOT DISTINCT FROM k.BRANDNAME
  LEFT JOIN bk ON bk.PRODUCTNAME IS NOT DISTINCT FROM k.PRODUCTNAME AND bk.BRANDNAME IS NOT DISTINCT FROM k.BRANDNAME
  LEFT JOIN fb ON fb.PRODUCTNAME IS NOT DISTINCT FROM k.PRODUCTNAME AND fb.BRANDNAME IS NOT DISTINCT FROM k.BRANDNAME),
fbapplied AS (
  SELECT *,
    NOT EXACT_HIT AND (C_CAT IS NULL OR C_CAT = '') AND coalesce(L_TYPE = 'flower' AND contains(L_CLEAN, 'preroll'), false) AS TAKE
  FROM chain),
r0 AS (
  SELECT PRODUCTNAME, BRANDNAME, L_NAME, L_BRAND,
    CASE WHEN TAKE THEN (CASE WHEN FB_HIT THEN FB_CAT END) ELSE C_CAT END AS R_CAT,
    CASE WHEN TAKE THEN (CASE WHEN FB_HIT THEN CAST(90 AS DOUBLE) END) ELSE C_SCORE END AS R_SCORE,
    CASE WHEN TAKE THEN (CASE WHEN FB_HIT THEN FB_NAME END) ELSE C_REF END AS R_REF,
    CASE WHEN TAKE THEN (CASE WHEN FB_HIT THEN 'Fallback Preroll Match' ELSE 'No Acceptable Match' END) ELSE C_LABEL END AS R_LABEL
  FROM fbapplied),
ladder AS (
  SELECT PRODUCTNAME, BRANDNAME,
    CASE WHEN BULK THEN CASE WHEN PREM THEN 'NEA Fire Bulk Flower g' ELSE 'NEA Bulk Flower g' END ELSE R_CAT END AS MATCHED_SNOP_CATEGORY,
    CASE WHEN BULK THEN CASE WHEN PREM THEN CAST(100 AS DOUBLE) ELSE CAST(95 AS DOUBLE) END ELSE R_SCORE END AS MATCH_SCORE,
    CASE WHEN BULK THEN CASE WHEN PREM THEN 'bulk name brand rule' ELSE 'bulk name rule' END ELSE R_REF END AS MATCHED_REFERENCE,
    CASE WHEN BULK THEN 'Bulk Override' ELSE R_LABEL END AS MATCH_RESULT
  FROM (SELECT *, (R_CAT IS NULL OR R_CAT = '') AND contains(L_NAME, 'bulk') AS BULK,
               contains(L_BRAND, 'brand#1') OR contains(L_NAME, 'brand#1') AS PREM FROM r0)),
labelled AS (
  SELECT x.*, CASE WHEN x.APPROVED THEN l.MATCHED_SNOP_CATEGORY END AS MATCHED_SNOP_CATEGORY,
         CASE WHEN x.APPROVED THEN l.MATCH_SCORE END AS MATCH_SCORE,
         CASE WHEN x.APPROVED THEN l.MATCHED_REFERENCE END AS MATCHED_REFERENCE,
         CASE WHEN x.APPROVED THEN l.MATCH_RESULT ELSE 'Wrong Brand' END AS MATCH_RESULT,
         x.APPROVED AND l.MATCHED_SNOP_CATEGORY IS NOT NULL AND l.MATCHED_SNOP_CATEGORY <> '' AS IS_MATCHED
  FROM s_ext x LEFT JOIN ladder l
    ON l.PRODUCTNAME IS NOT DISTINCT FROM x.PRODUCTNAME AND l.BRANDNAME IS NOT DISTINCT FROM x.BRANDNAME)"""

_SALES_LADDER_CTES = ("WITH RECURSIVE" + duckdb_ctes(["retail_sales", "catalog"])[len("WITH"):] + "," + _S_ROWS + ",\n"
                      + strict_ctes("w_keys") + ",\n" + backup_ctes("w_keys") + ",\n" + _LADDER)

ORACLE_SQL["sales_ladder"] = _SALES_LADDER_CTES + """
SELECT PRODUCTNAME, BRANDNAME, MATCHED_SNOP_CATEGORY, round(MATCH_SCORE, 4) AS MATCH_SCORE, MATCHED_REFERENCE, MATCH_RESULT
FROM ladder"""

ORACLE_SQL["daily_summary"] = _SALES_LADDER_CTES + """
SELECT LOCATIONNAME, TRANSACTIONDATE, MATCHED_SNOP_CATEGORY,
       round(coalesce(sum(TOTAL_QUANTITY), 0.0), 2) AS TOTAL_QUANTITY, round(coalesce(sum(TOTAL_REVENUE), 0.0), 4) AS TOTAL_REVENUE
FROM labelled WHERE IS_MATCHED
GROUP BY LOCATIONNAME, TRANSACTIONDATE, MATCHED_SNOP_CATEGORY"""
ORACLE_SQL["sales_pipeline"] = f"""
SELECT *, 'retail' AS CHANNEL FROM ({ORACLE_SQL['daily_summary']}) r
UNION ALL BY NAME
SELECT *, 'wholesale' AS CHANNEL FROM ({ORACLE_SQL['wholesale_daily_summary']}) w"""

ORACLE_SQL["category_summary"] = _SALES_LADDER_CTES + """
SELECT MATCHED_SNOP_CATEGORY, PRODUCTNAME,
       round(coalesce(sum(TOTAL_QUANTITY), 0.0), 2) AS TOTAL_QUANTITY, round(coalesce(sum(TOTAL_REVENUE), 0.0), 4) AS TOTAL_REVENUE,
       round(coalesce(sum(WEIGHTSOLD), 0.0), 2) AS WEIGHTSOLD
FROM labelled WHERE IS_MATCHED
GROUP BY MATCHED_SNOP_CATEGORY, PRODUCTNAME"""

ORACLE_SQL["match_rate"] = _SALES_LADDER_CTES + """
, counts AS (SELECT CAST(sum(CASE WHEN APPROVED THEN 1 ELSE 0 END) AS BIGINT) AS TOTAL_ROWS,
                    CAST(sum(CASE WHEN IS_MATCHED THEN 1 ELSE 0 END) AS BIGINT) AS MATCHED_ROWS FROM labelled)
SELECT TOTAL_ROWS, MATCHED_ROWS,
       CASE WHEN TOTAL_ROWS > 0 THEN round(MATCHED_ROWS * 100.0 / TOTAL_ROWS, 2) END AS MATCH_RATE
FROM counts"""

ORACLE_SQL["combined_sales"] = ("WITH RECURSIVE" + duckdb_ctes(["retail_sales", "catalog", "wholesale_sales"])[len("WITH"):]
                                + "," + _S_ROWS + ",\n" + strict_ctes("w_keys") + ",\n" + backup_ctes("w_keys") + ",\n"
                                + _LADDER + "," + _W_EXTRACT + """
, both_channels AS (
  SELECT LOCATIONNAME, TRANSACTIONDATE, MATCHED_SNOP_CATEGORY, PRODUCTNAME, BRANDNAME, TOTAL_QUANTITY, TOTAL_REVENUE,
         MATCH_RESULT, MATCH_SCORE, MATCHED_REFERENCE, CASE WHEN IS_MATCHED THEN 'matched' ELSE 'unmatched' END AS STATUS
  FROM labelled
  UNION ALL
  SELECT LOCATIONNAME, TRANSACTIONDATE, MATCHED_SNOP_CATEGORY, PRODUCTNAME, BRANDNAME, UNIT_COUNT, TOTAL_REVENUE,
         MATCH_RESULT, MATCH_SCORE, MATCHED_REFERENCE,
         CASE WHEN MATCHED_SNOP_CATEGORY IS NOT NULL THEN 'matched' ELSE 'unmatched' END
  FROM w_lab)
SELECT LOCATIONNAME, TRANSACTIONDATE, MATCHED_SNOP_CATEGORY, PRODUCTNAME, BRANDNAME, round(TOTAL_QUANTITY, 2) AS TOTAL_QUANTITY,
       round(TOTAL_REVENUE, 4) AS TOTAL_REVENUE, MATCH_RESULT, round(MATCH_SCORE, 4) AS MATCH_SCORE, MATCHED_REFERENCE, STATUS
FROM both_channels""")

# --------------------------------------------------------------------------- inventory ladder and reports

_IMC = "lower(coalesce(REF_CAT, 'None'))"
_IMS = strain("REF_CAT")
_I_CHECKS = {
    "pr_lock": f"NOT (contains({_IMC}, 'preroll') AND NOT contains(NAME_LC, 'preroll'))",
    "type_conflict": (f"NOT ((coalesce(P_TYPE, '') = 'flower' AND contains({_IMC}, 'concentrate'))"
                      f" OR (coalesce(P_TYPE, '') = 'concentrate' AND contains({_IMC}, 'flower')))"),
    "packaging": ("(NOT contains(NAME_LC, 'preroll') OR CASE WHEN P_PACK IS NOT NULL AND REF_PACK IS NOT NULL "
                  "THEN P_PACK = REF_PACK ELSE P_PACK IS NULL AND REF_PACK IS NULL END)"),
    "brand_lock": ("coalesce(BRANDNAME IS NULL OR BRANDNAME = '' OR REF_CAT IS NULL OR REF_CAT = '' OR NOT ("
                   + " OR ".join(f"(lower({strip('BRANDNAME')}) = 'brand#{i}' AND NOT contains(lower(REF_CAT), '{kw}'))"
                                 for i, kw in ((1, "brand#"), (2, "brand#"), (3, "brand#"), (4, "brand#4")))
                   + "), true)"),
    "infused_lock": f"contains(NAME_LC, 'infused') = contains({_IMC}, 'infused')",
    "strain_check": f"coalesce(P_STRAIN IS NULL OR {_IMS} IS NULL OR P_STRAIN = {_IMS}, true)",
    "strain_strict_lock": (f"coalesce(NOT coalesce(P_TYPE = 'flower', false) OR CASE WHEN P_STRAIN IS NOT NULL AND {_IMS} IS NOT NULL "
                           f"THEN P_STRAIN = {_IMS} ELSE true END, false)"),
    "grams_check": ("coalesce((P_GRAMS = 0 OR REF_GRAMS = 0) OR NOT coalesce(P_TYPE IN ('flower', 'concentrate', 'vape', 'preroll'), false)"
                    " OR (P_GRAMS IS NOT NULL AND REF_GRAMS IS NOT NULL"
                    " AND NOT ((P_GRAMS > 7 AND REF_GRAMS <= 3.5) OR (REF_GRAMS > 7 AND P_GRAMS <= 3.5))"
                    " AND abs(P_GRAMS - REF_GRAMS) <= 0.05), false)"),
}
_I_PASS = ("(" + " AND ".join(_I_CHECKS.values())
           + " AND (coalesce(P_TYPE, '') <> 'edible' OR coalesce(len(REF_FLAVORS) > 0 AND"
             " (len(list_intersect(P_FLAVORS, REF_FLAVORS)) >= 2 OR FSCORE >= 85), false))"
           + " AND NOT (" + any_of("NAME_LC", ("preground", "7g", "bulk", "ounce")) + f" AND contains({_IMC}, 'preroll'))"
           + " AND SCORE >= 75)")
_I_FAILED = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT ({c}) THEN '{n}' END" for n, c in _I_CHECKS.items()) + ")"


def _inv_flavor_list(x: str) -> str:
    return rf"list_filter(string_split_regex({flavor_text(x, True)}, '\s+'), lambda w: length(w) >= 3)"


_I_SNAP = f"""
i_rows AS (
  SELECT *, coalesce({inv_gate()}, false) AS APPROVED, {forced()} AS TYPE_FORCED FROM retail_inventory
  WHERE INVENTORYDATE = (SELECT max(INVENTORYDATE) FROM retail_inventory)
    AND QUANTITYAVAILABLE IS NOT NULL AND MASTERCATEGORY IN ({MASTER}) AND QUANTITYAVAILABLE > 0),
i_keys AS (SELECT DISTINCT PRODUCTNAME, BRANDNAME, TYPE_FORCED FROM i_rows WHERE APPROVED),
i_refs AS (
  SELECT REF_KEY, min(CATALOGPOS) AS REF_POS, arg_max_null(SNOPCATEGORY, CATALOGPOS) AS REF_CAT
  FROM (SELECT {normalize(clean('PRODUCTNAME'))} AS REF_KEY, SNOPCATEGORY, CATALOGPOS FROM catalog) c
  GROUP BY REF_KEY),
irt AS (SELECT *, {token_key('REF_KEY')} AS RTK, {grams('REF_KEY')} AS REF_GRAMS, {_inv_flavor_list('REF_KEY')} AS REF_FLAVORS,
               {strip(flavor_text('REF_KEY', True))} AS REF_FLAVOR_STR, {pack('REF_KEY')} AS REF_PACK FROM i_refs),
feats AS (
  SELECT PRODUCTNAME, BRANDNAME, TYPE_FORCED, {normalize(clean('PRODUCTNAME'))} AS CLEANED,
         {token_key(normalize(clean('PRODUCTNAME')))} AS TK, lower(coalesce(PRODUCTNAME, '')) AS NAME_LC,
         lower(coalesce(BRANDNAME, 'None')) AS BRAND_LC,
         CASE WHEN TYPE_FORCED THEN 'concentrate' ELSE {type_inventory('PRODUCTNAME')} END AS P_TYPE,
         {grams('PRODUCTNAME')} AS P_GRAMS, {strain('PRODUCTNAME')} AS P_STRAIN, {pack('PRODUCTNAME')} AS P_PACK,
         TRY_CAST({pack('PRODUCTNAME')} AS DECIMAL(38, 0)) AS P_PACK_NUM,
         {_inv_flavor_list('PRODUCTNAME')} AS P_FLAVORS, {strip(flavor_text('PRODUCTNAME', True))} AS P_FLAVOR_STR,
         {normalize(clean("concat(coalesce(PRODUCTNAME, ''), ' - ', coalesce(BRANDNAME, 'None'))"))} AS ALT_KEY
  FROM i_keys)"""

_I_STRICT = f"""
texts AS (SELECT DISTINCT TK FROM feats),
pairs AS (
  SELECT row_number() OVER () AS pid, t.TK AS A, r.RTK AS B, r.REF_KEY, r.REF_POS
  FROM texts t JOIN irt r ON 5 * least(length(t.TK), length(r.RTK)) >= 3 * greatest(length(t.TK), length(r.RTK))),
{lcs_ctes('', 'pairs')},
ranked AS (SELECT A, REF_KEY, SCORE, REF_POS, row_number() OVER (PARTITION BY A ORDER BY SCORE DESC, REF_POS ASC) AS RK FROM scored),
cand AS (
  SELECT f.*, k.REF_KEY, k.SCORE, k.REF_POS, r.REF_CAT, r.REF_GRAMS, r.REF_FLAVORS, r.REF_FLAVOR_STR, r.REF_PACK
  FROM feats f JOIN ranked k ON f.TK = k.A AND k.RK <= 5 JOIN irt r ON r.REF_KEY = k.REF_KEY),
fpairs AS (SELECT row_number() OVER () AS pid, A, B FROM
           (SELECT DISTINCT P_FLAVOR_STR AS A, REF_FLAVOR_STR AS B FROM cand WHERE P_TYPE = 'edible')),
{lcs_ctes('f', 'fpairs')},
judged AS (SELECT c.*, fs.SCORE AS FSCORE FROM cand c LEFT JOIN fscored fs ON fs.A = c.P_FLAVOR_STR AND fs.B = c.REF_FLAVOR_STR),
valid AS (SELECT * EXCLUDE (FSCORE) FROM judged WHERE {_I_PASS}),
pp AS (SELECT DISTINCT REF_KEY AS X, CLEANED AS Y FROM valid),
dirs AS (
  SELECT X, Y, CASE WHEN length(X) <= length(Y) THEN X ELSE Y END AS S, CASE WHEN length(X) <= length(Y) THEN Y ELSE X END AS L FROM pp
  UNION ALL
  SELECT X, Y, Y AS S, X AS L FROM pp WHERE length(X) = length(Y)),
windows AS (
  SELECT X, Y, S, substr(L, 1, i) AS W FROM (SELECT *, unnest(range(1, length(S))) AS i FROM dirs)
  UNION ALL
  SELECT X, Y, S, substr(L, k + 1, length(S)) FROM (SELECT *, unnest(range(0, length(L) - length(S) + 1)) AS k FROM dirs)
  UNION ALL
  SELECT X, Y, S, substr(L, k + 1) FROM (SELECT *, unnest(range(length(L) - length(S) + 1, length(L))) AS k FROM dirs)),
wpairs AS (SELECT row_number() OVER () AS pid, A, B FROM (SELECT DISTINCT S AS A, W AS B FROM windows WHERE S <> '')),
{lcs_ctes('w', 'wpairs')},
partial AS (SELECT w.X, w.Y, max(ws.SCORE) AS P FROM windows w JOIN wscored ws ON ws.A = w.S AND ws.B = w.W GROUP BY w.X, w.Y),
best AS (
  SELECT v.*, row_number() OVER (PARTITION BY v.PRODUCTNAME, v.BRANDNAME, v.TYPE_FORCED
                                 ORDER BY v.SCORE DESC, coalesce(p.P, 0) DESC, v.REF_POS ASC) AS BR
  FROM valid v LEFT JOIN partial p ON p.X = v.REF_KEY AND p.Y = v.CLEANED)"""

_I_BACKUP = f"""
ed AS (SELECT PRODUCTNAME, BRANDNAME, TYPE_FORCED, CLEANED AS X FROM feats WHERE P_TYPE = 'edible'),
cats AS (SELECT lower(SNOPCATEGORY) AS C, min(CATALOGPOS) AS CPOS FROM catalog WHERE SNOPCATEGORY IS NOT NULL GROUP BY lower(SNOPCATEGORY)),
pr_in AS (SELECT DISTINCT e.X, c.C FROM (SELECT DISTINCT X FROM ed) e, cats c),
{_PARTIAL},
bk_best AS (
  SELECT o.X, o.C, o.P, row_number() OVER (PARTITION BY o.X ORDER BY o.P DESC, c.CPOS ASC) AS RN
  FROM pr_out o JOIN cats c ON c.C = o.C)"""

_K3 = "{a}.PRODUCTNAME IS NOT DISTINCT FROM {b}.PRODUCTNAME AND {a}.BRANDNAME IS NOT DISTINCT FROM {b}.BRANDNAME AND {a}.TYPE_FORCED = {b}.TYPE_FORCED"

_I_LADDER = f"""
high AS (
  SELECT f.PRODUCTNAME, f.BRANDNAME, f.TYPE_FORCED, arg_min_null(r.REF_CAT, r.REF_POS) AS CAT, arg_min(r.REF_KEY, r.REF_POS) AS REF
  FROM feats f JOIN irt r ON f.TK = r.RTK GROUP BY f.PRODUCTNAME, f.BRANDNAME, f.TYPE_FORCED),
fbrows AS (
  SELECT PRODUCTNAME AS FB_NAME, SNOPCATEGORY AS FB_CAT, CATALOGPOS AS FB_POS,
         lower(coalesce(CAST(BRAND AS VARCHAR), 'None')) AS B, {strain('lower(PRODUCTNAME)')} AS S,
         TRY_CAST({pack('PRODUCTNAME')} AS DECIMAL(38, 0)) AS P, {grams('lower(PRODUCTNAME)')} AS G
  FROM catalog WHERE contains(lower(coalesce(PRODUCTNAME, 'None')), 'preroll')),
fb AS (
  SELECT k.PRODUCTNAME, k.BRANDNAME, k.TYPE_FORCED, arg_min_null(f.FB_CAT, f.FB_POS) AS FB_CAT, arg_min(f.FB_NAME, f.FB_POS) AS FB_NAME
  FROM feats k JOIN fbrows f ON k.BRAND_LC = f.B AND k.P_STRAIN IS NOT DISTINCT FROM f.S AND k.P_PACK_NUM IS NOT DISTINCT FROM f.P
  WHERE k.P_TYPE = 'flower' AND contains(k.CLEANED, 'preroll') AND contains(k.NAME_LC, 'preroll')
    AND k.P_GRAMS <> 0 AND f.G <> 0 AND abs(k.P_GRAMS - f.G) < 0.05
  GROUP BY k.PRODUCTNAME, k.BRANDNAME, k.TYPE_FORCED),
bk AS (SELECT e.PRODUCTNAME, e.BRANDNAME, e.TYPE_FORCED, b.C, b.P FROM ed e JOIN bk_best b ON b.X = e.X AND b.RN = 1 WHERE b.P >= 70),
st AS (SELECT PRODUCTNAME, BRANDNAME, TYPE_FORCED, REF_CAT, SCORE, REF_KEY FROM best WHERE BR = 1),
chain AS (
  SELECT k.*,
    CASE WHEN e1.REF_KEY IS NOT NULL THEN e1.REF_CAT WHEN e2.REF_KEY IS NOT NULL THEN e2.REF_CAT
         WHEN ex.PRODUCTNAME IS NOT NULL THEN ex.CAT WHEN hi.PRODUCTNAME IS NOT NULL THEN hi.CAT
         WHEN st.PRODUCTNAME IS NOT NULL THEN st.REF_CAT WHEN bk.PRODUCTNAME IS NOT NULL THEN bk.C END AS C_CAT,
    CASE WHEN e1.REF_KEY IS NOT NULL THEN CAST(100 AS DOUBLE) WHEN e2.REF_KEY IS NOT NULL THEN CAST(99 AS DOUBLE)
         WHEN ex.PRODUCTNAME IS NOT NULL THEN CAST(100 AS DOUBLE) WHEN hi.PRODUCTNAME IS NOT NULL THEN CAST(100 AS DOUBLE)
         WHEN st.PRODUCTNAME IS NOT NULL THEN st.SCORE WHEN bk.PRODUCTNAME IS NOT NULL THEN bk.P END AS C_SCORE,
    CASE WHEN e1.REF_KEY IS NOT NULL THEN k.CLEANED WHEN e2.REF_KEY IS NOT NULL THEN k.ALT_KEY
         WHEN ex.PRODUCTNAME IS NOT NULL THEN ex.XKEY WHEN hi.PRODUCTNAME IS NOT NULL THEN hi.REF
         WHEN st.PRODUCTNAME IS NOT NULL THEN st.REF_KEY WHEN bk.PRODUCTNAME IS NOT NULL THEN bk.C END AS C_REF,
    CASE WHEN e1.REF_KEY IS NOT NULL THEN 'Matched (Exact Match)' WHEN e2.REF_KEY IS NOT NULL THEN 'Matched (Exact Match w/ Brand)'
         WHEN ex.PRODUCTNAME IS NOT NULL THEN 'Matched (Exact Match – Name Exception)'
         WHEN hi.PRODUCTNAME IS NOT NULL THEN 'High-Confidence Override'
         WHEN st.PRODUCTNAME IS NOT NULL THEN 'Matched (Strict Rules)' WHEN bk.PRODUCTNAME IS NOT NULL THEN 'Backup S&OP Match'
         ELSE 'No Acceptable Match' END AS C_LABEL,
    fb.PRODUCTNAME IS NOT NULL AS FB_HIT, fb.FB_CAT, fb.FB_NAME
  FROM feats k
  LEFT JOIN i_refs e1 ON e1.REF_KEY = k.CLEANED
  LEFT JOIN i_refs e2 ON e2.REF_KEY = k.ALT_KEY
  LEFT JOIN exc_hits ex ON {_K3.format(a='ex', b='k')}
  LEFT JOIN high hi ON {_K3.format(a='hi', b='k')}
  LEFT JOIN st ON {_K3.format(a='st', b='k')}
  LEFT JOIN bk ON {_K3.format(a='bk', b='k')}
  LEFT JOIN fb ON {_K3.format(a='fb', b='k')}),
r0 AS (
  SELECT *, C_CAT IS NULL AND coalesce(P_TYPE = 'flower' AND contains(CLEANED, 'preroll'), false)
            AND FB_HIT AND coalesce(FB_CAT, '') <> '' AS TAKE
  FROM chain),
r1 AS (
  SELECT *, CASE WHEN TAKE THEN FB_CAT ELSE C_CAT END AS R_CAT, CASE WHEN TAKE THEN CAST(90 AS DOUBLE) ELSE C_SCORE END AS R_SCORE,
         CASE WHEN TAKE THEN FB_NAME ELSE C_REF END AS R_REF, CASE WHEN TAKE THEN 'Fallback Preroll Match' ELSE C_LABEL END AS R_LABEL
  FROM r0),
ladder AS (
  SELECT *,
    CASE WHEN BULK THEN CASE WHEN PREM THEN 'NEA Fire Bulk Flower g' ELSE 'NEA Bulk Flower g' END ELSE R_CAT END AS MATCHED_SNOP_CATEGORY,
    CASE WHEN BULK THEN CASE WHEN PREM THEN CAST(100 AS DOUBLE) ELSE CAST(95 AS DOUBLE) END ELSE R_SCORE END AS MATCH_SCORE,
    CASE WHEN BULK THEN CASE WHEN PREM THEN 'bulk name brand rule' ELSE 'bulk name rule' END ELSE R_REF END AS MATCHED_REFERENCE,
    CASE WHEN BULK THEN 'Bulk Override' ELSE R_LABEL END AS MATCH_RESULT
  FROM (SELECT *, R_CAT IS NULL AND contains(NAME_LC, 'bulk') AS BULK, contains(BRAND_LC, 'brand#1') AS PREM FROM r1)),
dk AS (SELECT * FROM ladder WHERE MATCH_RESULT = 'No Acceptable Match'),
dtexts AS (SELECT DISTINCT TK FROM dk),
dpairs AS (SELECT row_number() OVER () AS pid, t.TK AS A, r.RTK AS B, r.REF_KEY, r.REF_POS FROM dtexts t, irt r),
{lcs_ctes('d', 'dpairs')},
dbest AS (SELECT A, REF_KEY FROM (SELECT *, row_number() OVER (PARTITION BY A ORDER BY SCORE DESC, REF_POS ASC) AS RN FROM dscored) WHERE RN = 1),
diag AS (
  SELECT PRODUCTNAME, BRANDNAME, TYPE_FORCED, {_I_FAILED} AS FAILED_CHECKS
  FROM (SELECT d.PRODUCTNAME, d.BRANDNAME, d.TYPE_FORCED, d.NAME_LC, d.P_TYPE, d.P_GRAMS, d.P_STRAIN, d.P_PACK,
               r.REF_CAT, r.REF_GRAMS, r.REF_PACK
        FROM dk d JOIN dbest b ON b.A = d.TK JOIN irt r ON r.REF_KEY = b.REF_KEY)),
i_ladder AS (
  SELECT l.PRODUCTNAME, l.BRANDNAME, l.TYPE_FORCED, l.MATCHED_SNOP_CATEGORY, l.MATCH_SCORE, l.MATCHED_REFERENCE, l.MATCH_RESULT,
         g.FAILED_CHECKS
  FROM ladder l LEFT JOIN diag g ON {_K3.format(a='g', b='l')}),
i_labelled AS (
  SELECT x.*, CASE WHEN x.APPROVED THEN l.MATCHED_SNOP_CATEGORY END AS MATCHED_SNOP_CATEGORY,
         CASE WHEN x.APPROVED THEN l.MATCH_SCORE END AS MATCH_SCORE,
         CASE WHEN x.APPROVED THEN l.MATCHED_REFERENCE END AS MATCHED_REFERENCE,
         CASE WHEN x.APPROVED THEN l.MATCH_RESULT ELSE 'Wrong Brand' END AS MATCH_RESULT,
         coalesce(x.QUANTITYAVAILABLE, 0.0) AS TOTAL_QUANTITY,
         coalesce(x.APPROVED AND l.MATCHED_SNOP_CATEGORY IS NOT NULL AND {strip('l.MATCHED_SNOP_CATEGORY')} <> '', false) AS IS_MATCHED
  FROM i_rows x LEFT JOIN i_ladder l ON {_K3.format(a='l', b='x')})"""

_INV_CTES = ("WITH RECURSIVE" + duckdb_ctes(["retail_inventory", "catalog"])[len("WITH"):] + "," + _I_SNAP + ","
             + exception_ctes("i_keys") + ",\n" + _I_STRICT + ",\n" + _I_BACKUP + ",\n" + _I_LADDER)

ORACLE_SQL["inventory_ladder"] = _INV_CTES + """
SELECT PRODUCTNAME, BRANDNAME, TYPE_FORCED, MATCHED_SNOP_CATEGORY, round(MATCH_SCORE, 4) AS MATCH_SCORE, MATCHED_REFERENCE,
       MATCH_RESULT, FAILED_CHECKS
FROM i_ladder"""

ORACLE_SQL["failed_checks"] = _INV_CTES + """
SELECT PRODUCTNAME, BRANDNAME, TYPE_FORCED, FAILED_CHECKS FROM i_ladder WHERE MATCH_RESULT = 'No Acceptable Match'"""

_TBO = ORACLE_SQL["trim_bulk_override"]
_WI_LAB = _TBO[_TBO.index(", conv AS ("):_TBO.index("\nSELECT LOCATIONNAME, INVENTORYDATE,")]
_WI_FINAL = "wi_final AS (" + _TBO[_TBO.index("\nSELECT LOCATIONNAME, INVENTORYDATE,"):] + ")"

_INV_ALL_CTES = ("WITH RECURSIVE" + duckdb_ctes(["retail_inventory", "catalog", "wholesale_inventory"])[len("WITH"):] + ","
                 + _I_SNAP + "," + exception_ctes("i_keys") + ",\n" + _I_STRICT + ",\n" + _I_BACKUP + ",\n" + _I_LADDER
                 + "," + _WI_SNAP + _WI_LAB + ",\n" + _WI_FINAL + """,
inv_both AS (
  SELECT LOCATIONNAME, INVENTORYDATE, MATCHED_SNOP_CATEGORY, PRODUCTNAME, BRANDNAME, TOTAL_QUANTITY, MATCH_RESULT, MATCH_SCORE,
         MATCHED_REFERENCE, CASE WHEN IS_MATCHED THEN 'matched' ELSE 'unmatched' END AS STATUS
  FROM i_labelled
  UNION ALL
  SELECT LOCATIONNAME, INVENTORYDATE, MATCHED_SNOP_CATEGORY, PRODUCTNAME, BRANDNAME, TOTAL_QUANTITY, MATCH_RESULT, MATCH_SCORE,
         MATCHED_REFERENCE,
         CASE WHEN MATCHED_SNOP_CATEGORY IS NOT NULL AND trim(MATCHED_SNOP_CATEGORY) <> '' THEN 'matched' ELSE 'unmatched' END
  FROM wi_final)""")

ORACLE_SQL["combined_inventory"] = _INV_ALL_CTES + """
SELECT LOCATIONNAME, INVENTORYDATE, MATCHED_SNOP_CATEGORY, PRODUCTNAME, BRANDNAME, round(TOTAL_QUANTITY, 2) AS TOTAL_QUANTITY,
       MATCH_RESULT, round(MATCH_SCORE, 4) AS MATCH_SCORE, MATCHED_REFERENCE, STATUS
FROM inv_both"""

ORACLE_SQL["inventory_pipeline"] = _INV_ALL_CTES + """
SELECT LOCATIONNAME, INVENTORYDATE, MATCHED_SNOP_CATEGORY, PRODUCTNAME, BRANDNAME, round(TOTAL_QUANTITY, 2) AS TOTAL_QUANTITY,
       MATCH_RESULT, round(MATCH_SCORE, 4) AS MATCH_SCORE, MATCHED_REFERENCE
FROM inv_both WHERE STATUS = 'matched'"""

# Reloads: the batch, and of the older load (the batch some days off, with twice the quantity) what the reload leaves.
ORACLE_SQL["snapshot_reload"] = ORACLE_SQL["combined_inventory"].replace("FROM inv_both", """FROM (
  SELECT * FROM inv_both
  UNION ALL
  SELECT * REPLACE (INVENTORYDATE - 1 AS INVENTORYDATE, TOTAL_QUANTITY * 2 AS TOTAL_QUANTITY) FROM inv_both)""")
ORACLE_SQL["window_reload"] = ORACLE_SQL["combined_sales"].replace("FROM both_channels", """FROM (
  SELECT * FROM both_channels
  UNION ALL
  SELECT * REPLACE (TRANSACTIONDATE - 45 AS TRANSACTIONDATE, TOTAL_QUANTITY * 2 AS TOTAL_QUANTITY) FROM both_channels
  WHERE TRANSACTIONDATE - 45 < (SELECT least(min(TRANSACTIONDATE), max(TRANSACTIONDATE) - 90) FROM both_channels))""")


def _controls(ctes: str, rows: str, name: str) -> str:
    return ctes + f"""
SELECT '{name}' AS TABLE_NAME, s.STATUS, count(r.STATUS) AS ROWS, round(coalesce(sum(r.TOTAL_QUANTITY), 0.0), 2) AS QUANTITY_BEFORE,
       count(*) FILTER (WHERE r.STATUS IS NOT NULL AND r.TOTAL_QUANTITY IS NULL) AS NULLS_BEFORE,
       round(coalesce(sum(r.TOTAL_QUANTITY), 0.0), 2) AS QUANTITY_AFTER,
       count(*) FILTER (WHERE r.STATUS IS NOT NULL AND r.TOTAL_QUANTITY IS NULL) AS NULLS_AFTER
FROM (VALUES ('matched'), ('unmatched')) s(STATUS) LEFT JOIN {rows} r ON r.STATUS = s.STATUS GROUP BY s.STATUS"""


_SALES_ALL_CTES = ORACLE_SQL["combined_sales"][:ORACLE_SQL["combined_sales"].index("\nSELECT LOCATIONNAME, TRANSACTIONDATE, MATCHED_SNOP_CATEGORY, PRODUCTNAME, BRANDNAME, round(")]
ORACLE_SQL["combined_controls"] = f"""
SELECT * FROM ({_controls(_SALES_ALL_CTES, 'both_channels', 'sales')})
UNION ALL
SELECT * FROM ({_controls(_INV_ALL_CTES, 'inv_both', 'inventory')})"""

_EXPORTED = "count(*) AS ROWS, round(sum({q}), 2) AS QUANTITY, round({r}, 2) AS REVENUE, count({n}) AS NAMED"
_SALES_FILE = _EXPORTED.format(q="UNIT_COUNT", r="sum(TOTAL_REVENUE)", n="PRODUCTNAME")
_STOCK_FILE = _EXPORTED.format(q="TOTAL_QUANTITY", r="CAST(NULL AS DOUBLE)", n="PRODUCTNAME")
ORACLE_SQL["csv_exports"] = f"""
SELECT 'matched_sales_with_snop_category' AS FILE, {_SALES_FILE} FROM ({ORACLE_SQL['wholesale_units']}) WHERE MATCHED_SNOP_CATEGORY IS NOT NULL
UNION ALL SELECT 'unmatched_sales_without_snop_category', {_SALES_FILE} FROM ({ORACLE_SQL['wholesale_units']}) WHERE MATCHED_SNOP_CATEGORY IS NULL
UNION ALL SELECT 'matched_category_summary', {_SALES_FILE} FROM ({ORACLE_SQL['wholesale_category_summary']})
UNION ALL SELECT 'daily_category_summary', {_EXPORTED.format(q='UNIT_COUNT', r='sum(TOTAL_REVENUE)', n='TRANSACTIONDATE')}
  FROM ({ORACLE_SQL['wholesale_daily_summary']})
UNION ALL SELECT 'matched_wholesale_inventory', {_STOCK_FILE} FROM ({ORACLE_SQL['trim_bulk_override']}) WHERE MATCHED_SNOP_CATEGORY IS NOT NULL
UNION ALL SELECT 'unmatched_wholesale_inventory', {_STOCK_FILE} FROM ({ORACLE_SQL['trim_bulk_override']}) WHERE MATCHED_SNOP_CATEGORY IS NULL"""

# A catalog with many rows a name: the last category by position wins, the first position orders.
ORACLE_SQL["catalog_last_wins"] = duckdb_ctes(["product"]) + """
, c AS (SELECT PRODUCTNAME, PRODUCTSKU AS SNOPCATEGORY, PRODUCTID AS POS FROM product)
SELECT 'exact' AS MAP, PRODUCTNAME AS NAME, CAST(NULL AS BIGINT) AS FIRST_POS, arg_max(SNOPCATEGORY, POS) AS CATEGORY
FROM c WHERE SNOPCATEGORY IS NOT NULL GROUP BY PRODUCTNAME
UNION ALL
SELECT 'reference', lower(PRODUCTNAME), min(POS), arg_max_null(SNOPCATEGORY, POS) FROM c GROUP BY lower(PRODUCTNAME)"""

# The wholesale inventory beside a channel without a quantity, under the original's column names.
ORACLE_SQL["reference_layout"] = f"""
SELECT LOCATIONNAME, INVENTORYDATE, PRODUCTNAME, BRANDNAME, MATCHED_SNOP_CATEGORY AS "Matched S&OP Category", MATCH_RESULT AS "Match Result",
       TOTAL_QUANTITY
FROM ({ORACLE_SQL['trim_bulk_override']})
UNION ALL
SELECT LOCATIONNAME, INVENTORYDATE, PRODUCTNAME, BRANDNAME, CATEGORY, 'No Acceptable Match', CAST(NULL AS DOUBLE)
FROM ({ORACLE_SQL['retail_latest_snapshot']})"""


def _accounting(ctes: str, rows: str, channel: str) -> str:
    return ctes + f"""
SELECT CAST(count(*) AS BIGINT) AS INPUT_ROWS,
       CAST(sum(CASE WHEN APPROVED THEN 1 ELSE 0 END) AS BIGINT) AS SOURCE_ROWS,
       CAST(sum(CASE WHEN APPROVED AND M THEN 1 ELSE 0 END) AS BIGINT) AS MATCHED_ROWS,
       CAST(sum(CASE WHEN APPROVED AND NOT M THEN 1 ELSE 0 END) AS BIGINT) AS UNMATCHED_CORE_ROWS,
       CAST(sum(CASE WHEN NOT APPROVED THEN 1 ELSE 0 END) AS BIGINT) AS WRONG_BRAND_ROWS,
       '{channel}' AS CHANNEL
FROM (SELECT APPROVED, coalesce(MATCHED_SNOP_CATEGORY IS NOT NULL AND trim(MATCHED_SNOP_CATEGORY) <> '', false) AS M FROM {rows})"""


ORACLE_SQL["row_accounting"] = f"""
SELECT *, MATCHED_ROWS + UNMATCHED_CORE_ROWS = SOURCE_ROWS AND SOURCE_ROWS + WRONG_BRAND_ROWS = INPUT_ROWS AS BALANCED
FROM (
  SELECT * FROM ({_accounting(_SALES_LADDER_CTES, 'labelled', 'retail_sales')})
  UNION ALL
  SELECT * FROM ({_accounting(_INV_CTES, 'i_labelled', 'retail_inventory')}))"""

#: Every CTE is evaluated once: without this DuckDB inlines the long chains again and again, and fails on some of them.
ORACLE_SQL = {name: re.sub(r"(?<![)\w])([A-Za-z_]\w*) AS \(", r"\1 AS MATERIALIZED (", sql) for name, sql in ORACLE_SQL.items()}
