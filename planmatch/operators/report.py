"""Summaries, match rate, row accounting and control totals.

Accounting and controls of a run are observed while its output is written: no row is read for them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from planmatch.functions.text import strip_ws

CAT = "MATCHED_SNOP_CATEGORY"


def _sums(cols):
    # an all-null group sums to 0, as the original's pandas summaries do
    return [F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in cols]


def category_summary(matched: DataFrame, value_cols=("TOTAL_QUANTITY", "TOTAL_REVENUE", "WEIGHTSOLD")) -> DataFrame:
    """Totals per (category, product); null keys form their own group."""
    return matched.groupBy(CAT, "PRODUCTNAME").agg(*_sums(value_cols))


def daily_summary(matched: DataFrame, value_cols=("TOTAL_QUANTITY", "TOTAL_REVENUE")) -> DataFrame:
    """Totals per (location, date, category)."""
    return matched.groupBy("LOCATIONNAME", "TRANSACTIONDATE", CAT).agg(*_sums(value_cols))


def is_matched(cat_col: str = CAT, blank: str = "unmatched"):
    """Whether a row has a category.

    ``blank`` says what a category without text is: "unmatched", also if it is white space only (the inventory
    tables); "empty", unmatched only if it is the empty string (retail sales); "matched" (wholesale sales).
    """
    cat = F.col(cat_col)
    if blank == "matched":
        return cat.isNotNull()
    text = cat if blank == "empty" else strip_ws(cat)
    return F.coalesce(cat.isNotNull() & (text != ""), F.lit(False))


def match_rate(labelled: DataFrame, approved_col: str = "APPROVED") -> DataFrame:
    """matched / gated source rows * 100, rounded to 2 places (NULL on an empty source)."""
    approved = F.col(approved_col)
    matched = approved & is_matched(blank="empty")
    return labelled.agg(
        F.sum(F.when(approved, 1).otherwise(0)).cast("long").alias("TOTAL_ROWS"),
        F.sum(F.when(matched, 1).otherwise(0)).cast("long").alias("MATCHED_ROWS"),
    ).select(
        "TOTAL_ROWS", "MATCHED_ROWS",
        F.round(F.try_divide(F.col("MATCHED_ROWS") * 100.0, F.col("TOTAL_ROWS")), 2).alias("MATCH_RATE"),
    )


def row_accounting(gated: DataFrame, matched: DataFrame, unmatched: DataFrame,
                   approved_col: str = "APPROVED") -> DataFrame:
    """Rows before the join to the key results vs rows of the two output frames, each counted on its own.

    A row that the join or the split loses or repeats makes BALANCED false.  Wrong-brand rows are unmatched rows
    reported apart.
    """
    approved = F.col(approved_col)
    rows = (gated.select(F.lit("in").alias("SIDE"), approved.alias("OK"))
            .unionAll(matched.select(F.lit("matched"), F.lit(True)))
            .unionAll(unmatched.select(F.lit("unmatched"), approved)))

    def counted(cond, name):
        return F.count(F.when(cond, 1)).alias(name)

    side, ok = F.col("SIDE"), F.col("OK")
    out = rows.agg(
        counted(side == "in", "INPUT_ROWS"),
        counted((side == "in") & ok, "SOURCE_ROWS"),
        counted(side == "matched", "MATCHED_ROWS"),
        counted((side == "unmatched") & ok, "UNMATCHED_CORE_ROWS"),
        counted((side == "unmatched") & ~ok, "WRONG_BRAND_ROWS"),
    )
    return out.withColumn(
        "BALANCED",
        (F.col("MATCHED_ROWS") + F.col("UNMATCHED_CORE_ROWS") == F.col("SOURCE_ROWS"))
        & (F.col("SOURCE_ROWS") + F.col("WRONG_BRAND_ROWS") == F.col("INPUT_ROWS")),
    )


def balanced(m: dict) -> dict:
    """Accounting row of observed counts, with BALANCED."""
    ok = m["MATCHED_ROWS"] + m["UNMATCHED_CORE_ROWS"] == m["SOURCE_ROWS"] and m["SOURCE_ROWS"] + m["WRONG_BRAND_ROWS"] == m["INPUT_ROWS"]
    return {**m, "BALANCED": ok}


def assert_balanced(accounting_row) -> None:
    if not accounting_row["BALANCED"]:
        row = accounting_row if isinstance(accounting_row, dict) else accounting_row.asDict()
        raise AssertionError(f"row accounting mismatch: {row}")


def _count(cond):
    return F.count(F.when(cond, 1))


def observe_source(gated: DataFrame, name: str, approved_col: str = "APPROVED") -> tuple[DataFrame, Observation]:
    """Counts the rows that go into the join to the key results."""
    seen = Observation(name)
    return gated.observe(seen, F.count(F.lit(1)).alias("INPUT_ROWS"), _count(F.col(approved_col)).alias("SOURCE_ROWS")), seen


def observe_output(out: DataFrame, name: str, status_col: str = "STATUS", approved_col: str = "APPROVED") -> tuple[DataFrame, Observation]:
    """Counts the rows that come out of it, by what became of them."""
    seen = Observation(name)
    lost = F.col(status_col) != "matched"
    return out.observe(seen, _count(~lost).alias("MATCHED_ROWS"), _count(lost & F.col(approved_col)).alias("UNMATCHED_CORE_ROWS"),
                       _count(lost & ~F.col(approved_col)).alias("WRONG_BRAND_ROWS")), seen


def observe_controls(df: DataFrame, raw_qty: str, name: str, status_col: str = "STATUS") -> tuple[DataFrame, Observation]:
    """Rows, sum and nulls of the quantity before (``raw_qty``) and after its conversion to a number, by status."""
    seen, totals = Observation(name), []
    for status in ("matched", "unmatched"):
        own = F.col(status_col) == status
        raw, qty = F.col(raw_qty).try_cast("double"), F.col("TOTAL_QUANTITY")
        totals += [_count(own).alias(f"{status}_ROWS"),
                   F.coalesce(F.sum(F.when(own, raw)), F.lit(0.0)).alias(f"{status}_QUANTITY_BEFORE"),
                   _count(own & F.col(raw_qty).isNull()).alias(f"{status}_NULLS_BEFORE"),
                   F.coalesce(F.sum(F.when(own, qty)), F.lit(0.0)).alias(f"{status}_QUANTITY_AFTER"),
                   _count(own & qty.isNull()).alias(f"{status}_NULLS_AFTER")]
    return df.observe(seen, *totals), seen


def controls_rows(tables: dict) -> list[dict]:
    """One row per combined table and status from observed controls."""
    fields = ("ROWS", "QUANTITY_BEFORE", "NULLS_BEFORE", "QUANTITY_AFTER", "NULLS_AFTER")
    return [{"TABLE_NAME": name, "STATUS": status, **{f: m[f"{status}_{f}"] for f in fields}}
            for name, m in tables.items() for status in ("matched", "unmatched")]
