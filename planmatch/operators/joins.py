"""Join helpers: size-checked broadcast, null-safe key joins."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planmatch.session import checkpoint_dir

# Dimension sides are broadcast only when both bounds hold; larger ones take
# a shuffle join.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: made once, of known size, safe from lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Parquet files hold less than their rows do in memory: the plan's estimate counts so many times.
PLAN_FACTOR = 16


def plan_bytes(df: DataFrame) -> int | None:
    """The optimiser's size of ``df`` from the files it reads; None where a generator may make more rows than it counts."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if any(node in plan.toString() for node in ("Generate ", "Expand ")):
        return None
    return int(str(plan.stats().sizeInBytes()))


def proven_size(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes (serialised JSON length, an over-estimate) of ``df``, by one distributed aggregate."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(row)), F.lit(0))).first())


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only when it is proven to be small.

    The plan's statistics prove it without a job where ``df`` comes from small files.  Otherwise a distributed
    aggregate counts rows (<= ``max_rows``) and bytes (<= ``max_bytes``).
    """
    known = plan_bytes(df)
    if known is not None and known * PLAN_FACTOR <= max_bytes:
        return F.broadcast(df), True
    n, size = proven_size(df)
    if n <= max_rows and size <= max_bytes:
        return F.broadcast(df), True
    return df, False


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` with ``<=>`` (null equals null); keeps the left key columns."""
    renamed = {k: f"__r_{k}" for k in keys}
    # one projection renames every key (one analysis of the right plan, not one per key)
    r = right.select(*[F.col(f"`{c}`").alias(renamed.get(c, c)) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[renamed[k]]) for k in keys])
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    return out.drop(*renamed.values())
