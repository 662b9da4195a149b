"""Unit conversion to a common count (wholesale), as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from planmatch.config import WHOLESALE, WholesaleRules
from planmatch.functions.text import contains_any, strip_ws


def _is_bulk(name: str, rules: WholesaleRules) -> Column:
    return contains_any(F.upper(F.coalesce(F.col(name), F.lit(""))), rules.bulk_words)


def sales_unit_count(rules: WholesaleRules = WHOLESALE, qty: str = "QUANTITY", upc: str = "UNITSPERCASE",
                     unit: str = "WEIGHTUNIT", name: str = "PRODUCTNAME") -> Column:
    """Grams + BULK/TRIM name: pounds -> grams; Grams / Units: as is; else x units per case.

    A missing quantity counts as 0 and a missing units-per-case as 1; a value
    that is not numeric yields 0.0.
    """
    u = F.coalesce(strip_ws(F.col(unit)), F.lit(""))
    q = F.col(qty).try_cast("double")
    n = F.coalesce(F.col(upc).try_cast("double"), F.lit(1.0))
    q0 = F.coalesce(q, F.lit(0.0))
    out = (
        F.when(u == F.lit(rules.grams_unit), F.when(_is_bulk(name, rules), q0 * F.lit(rules.pound_in_grams)).otherwise(q0))
        .when(u.isin(list(rules.unit_units)), q0)
        .otherwise(q0 * n)
    )
    bad = (F.col(qty).isNotNull() & q.isNull()) | (F.col(upc).isNotNull() & F.col(upc).try_cast("double").isNull())
    return F.when(bad, F.lit(0.0)).otherwise(out)


def inventory_unit_count(rules: WholesaleRules = WHOLESALE, qty: str = "QUANTITYONHAND",
                         upc: str = "UNITSPERCASE", name: str = "PRODUCTNAME") -> Column:
    """BULK/TRIM name: pounds -> grams whatever the unit; else x units per case (0 or missing -> 1)."""
    q = F.col(qty).try_cast("double")
    n = F.col(upc).try_cast("double")
    q0 = F.coalesce(F.when(q != 0, q), F.lit(0.0))
    n1 = F.coalesce(F.when(n != 0, n), F.lit(1.0))
    out = F.when(_is_bulk(name, rules), q0 * F.lit(rules.pound_in_grams)).otherwise(
        F.when(n1 != 1.0, q0 * n1).otherwise(q0)
    )
    bad = (F.col(qty).isNotNull() & q.isNull()) | (F.col(upc).isNotNull() & n.isNull())
    return F.when(bad, F.lit(0.0)).otherwise(out)
