"""Test inputs derived from the driver tables.

The same SQL text defines the views on Spark (tables bound as DataFrame
parameters of ``spark.sql``) and in the DuckDB oracle (inlined as CTEs), so
both engines see identical inputs.  Nulls, blanks, re-ordered words, mojibake,
prefixes and upper-cased brands are injected on purpose; see FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from planmatch.operators.joins import DEFAULT_BROADCAST_BYTES, PLAN_FACTOR, plan_bytes
from planmatch.session import ship_package

BASE_TABLES = ("part", "lineitem", "orders", "customer", "nation", "supplier", "events")

# name -> SQL template; {name} placeholders refer to base tables or earlier views.
VIEWS: dict[str, str] = {
    "product": """
SELECT p_partkey AS PRODUCTID,
  concat(
    CASE WHEN p_partkey % 11 = 0 THEN 'AU:' WHEN p_partkey % 13 = 0 THEN 'MED: ' ELSE '' END,
    CASE WHEN p_partkey % 60 = 0 THEN replace(p_name, 'o', 'Ã³')
         WHEN p_partkey % 40 = 20 AND p_partkey % 100 <> 0 THEN concat(split_part(p_name, ' ', 2), ' ', split_part(p_name, ' ', 1))
         ELSE p_name END, ' ',
    CASE p_type WHEN 'ECONOMY' THEN 'Indica Flower' WHEN 'STANDARD' THEN 'Sativa Preroll'
                WHEN 'PROMO' THEN 'Hybrid Gummies' WHEN 'MEDIUM' THEN 'Live Resin'
                WHEN 'SMALL' THEN 'Vape Cartridge' ELSE 'Bulk Trim' END,
    CASE WHEN p_size % 5 = 0 THEN ''
         WHEN p_type = 'PROMO' THEN CASE p_size % 3 WHEN 0 THEN ' 100mg' WHEN 1 THEN ' 50mg' ELSE ' 5mg' END
         ELSE CASE p_size % 4 WHEN 0 THEN ' 1g' WHEN 1 THEN ' 3.5g' WHEN 2 THEN ' 7g' ELSE ' 28g' END END,
    CASE WHEN p_type = 'STANDARD' AND p_size % 3 = 0 THEN ' (5pk)' ELSE '' END,
    CASE WHEN p_partkey % 29 = 0 THEN ' infused' ELSE '' END) AS PRODUCTNAME,
  CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 37 = 0 THEN '' WHEN p_partkey % 41 = 0 THEN upper(p_brand) ELSE p_brand END AS BRANDNAME,
  CASE WHEN p_type IN ('MEDIUM', 'SMALL') THEN 'MIPs' WHEN p_type = 'LARGE' AND p_partkey % 2 = 0 THEN 'Other' ELSE 'Flower' END AS MASTERCATEGORY,
  CASE p_type WHEN 'MEDIUM' THEN 'Concentrates' ELSE p_type END AS CATEGORY,
  CASE WHEN p_partkey % 23 = 0 THEN NULL WHEN p_partkey % 47 = 0 THEN '' ELSE concat('SKU-', p_brand, '-', p_type) END AS PRODUCTSKU,
  p_size AS UNITSPERCASE, p_retailprice AS UNITCOST
FROM {part}""",
    "catalog": """
SELECT min(p_partkey) AS CATALOGPOS, PRODUCTNAME, max(SNOPCATEGORY) AS SNOPCATEGORY, max(p_brand) AS BRAND
FROM (SELECT p_partkey, p_brand,
        concat(name, ' ', kind, size, pack, CASE WHEN p_partkey % 100 = 0 THEN concat(' - ', p_brand) ELSE '' END) AS PRODUCTNAME,
        CASE WHEN p_partkey % 140 = 0 THEN NULL ELSE concat(p_brand, ' ', kind) END AS SNOPCATEGORY
      FROM (SELECT p_partkey, p_brand,
              CASE WHEN p_partkey % 60 = 0 THEN replace(p_name, 'o', 'ó') ELSE p_name END AS name,
              CASE p_type WHEN 'ECONOMY' THEN 'Indica Flower' WHEN 'STANDARD' THEN 'Sativa Preroll'
                          WHEN 'PROMO' THEN 'Hybrid Gummies' WHEN 'MEDIUM' THEN 'Concentrate Live Resin'
                          WHEN 'SMALL' THEN 'Vape Cartridge' ELSE 'Flower' END AS kind,
              CASE WHEN (p_partkey % 60 = 0 OR p_partkey % 100 = 0) AND p_size % 5 = 0 THEN ''
                   WHEN (p_partkey % 60 = 0 OR p_partkey % 100 = 0) AND p_type = 'PROMO' THEN CASE p_size % 3 WHEN 0 THEN ' 100mg' WHEN 1 THEN ' 50mg' ELSE ' 5mg' END
                   ELSE CASE p_size % 4 WHEN 0 THEN ' 1g' WHEN 1 THEN ' 3.5g' WHEN 2 THEN ' 7g' ELSE CASE WHEN p_partkey % 60 = 0 OR p_partkey % 100 = 0 THEN ' 28g' ELSE '' END END END AS size,
              CASE WHEN p_type = 'STANDARD' AND p_size % 3 = 0 THEN ' (5pk)' ELSE '' END AS pack
            FROM {part}) a) b
GROUP BY PRODUCTNAME""",
    "retail_sales": """
SELECT n.n_name AS LOCATIONNAME, p.PRODUCTID, p.PRODUCTNAME, p.PRODUCTSKU AS SKU, p.MASTERCATEGORY, p.BRANDNAME, p.CATEGORY,
  CAST(p.UNITSPERCASE AS DOUBLE) AS PRODUCTGRAMS, CAST(l.l_shipdate AS DATE) AS TRANSACTIONDATE, l.l_orderkey AS TRANSACTIONID,
  l.l_quantity AS QUANTITY, l.l_extendedprice * (1 - l.l_discount) AS NETSALEFORITEM, p.UNITCOST,
  CASE WHEN l.l_linestatus = 'F' THEN 'RETAIL' ELSE 'Medical' END AS TRANSACTIONTYPE,
  CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_shipdate AS DATE) END AS RETURNDATE,
  CASE WHEN o.o_orderstatus = 'P' THEN 'true' ELSE 'false' END AS ISVOID
FROM {lineitem} l JOIN {product} p ON l.l_partkey = p.PRODUCTID JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey""",
    "wholesale_sales": """
SELECT CAST(l.l_shipdate AS DATE) AS DELIVERYDATE, p.PRODUCTNAME, p.BRANDNAME AS BRAND, p.PRODUCTSKU,
  CASE l.l_linenumber % 4 WHEN 0 THEN 'Grams' WHEN 1 THEN 'Units' WHEN 2 THEN NULL ELSE 'Case' END AS WEIGHTUNIT,
  CASE WHEN p.PRODUCTID % 43 = 0 THEN NULL ELSE p.UNITSPERCASE END AS UNITSPERCASE,
  s.s_name AS BUYERNAME, l.l_quantity AS QUANTITY, l.l_extendedprice AS LINETOTAL
FROM {lineitem} l JOIN {product} p ON l.l_partkey = p.PRODUCTID JOIN {supplier} s ON l.l_suppkey = s.s_suppkey""",
    "retail_inventory": """
SELECT n.n_name AS LOCATIONNAME, p.PRODUCTID, p.PRODUCTNAME, p.BRANDNAME, p.MASTERCATEGORY, p.CATEGORY, CAST(e.ts AS DATE) AS INVENTORYDATE,
  CASE WHEN e.event_type = 'error' THEN NULL WHEN e.event_type = 'signup' THEN 0.0 ELSE e.value END AS QUANTITYAVAILABLE
FROM {events} e JOIN {product} p ON e.event_id % (SELECT count(*) FROM {part}) = p.PRODUCTID JOIN {nation} n ON e.user_id % 25 = n.n_nationkey""",
    "wholesale_inventory": """
SELECT p.PRODUCTNAME, p.BRANDNAME AS BRAND, p.PRODUCTSKU, 'Units' AS UNITSIZE, CASE WHEN p.PRODUCTID % 43 = 0 THEN NULL ELSE p.UNITSPERCASE END AS UNITSPERCASE,
  CAST(e.ts AS DATE) AS INVENTORYDATE, CASE WHEN e.event_type = 'error' THEN NULL ELSE e.value END AS QUANTITY, e.event_type = 'signup' AS PRODUCTARCHIVED
FROM {events} e JOIN {product} p ON e.event_id % (SELECT count(*) FROM {part}) = p.PRODUCTID""",
}

_DEPS = {
    "product": ("part",),
    "catalog": ("part",),
    "retail_sales": ("lineitem", "product", "orders", "customer", "nation"),
    "wholesale_sales": ("lineitem", "product", "supplier"),
    "retail_inventory": ("events", "product", "part", "nation"),
    "wholesale_inventory": ("events", "product", "part"),
}

#: Sides that the views join to their facts; those that are not proven small are never sent through the driver.
_SIDES = ("product", "orders", "customer", "supplier")
_PARTS = "(SELECT count(*) FROM {part})"
#: Bytes of ``part`` in files for one task: its few bytes are much work a row.
PART_BYTES = 256 * 1024


def _spread(part: DataFrame) -> DataFrame:
    """``part`` over several tasks, however few files hold it; a small table stays as it is."""
    n = min((plan_bytes(part) or 0) // PART_BYTES, int(part.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    return part.repartition(n, "p_partkey") if n > 1 else part


def _side(df: DataFrame) -> DataFrame:
    """A side of a join: shuffled if its files do not prove it small."""
    size = plan_bytes(df)
    return df if size is not None and size * PLAN_FACTOR <= DEFAULT_BROADCAST_BYTES else df.hint("merge")


class FixtureTables:
    """Lazily built fixture views over ``{sf_dir}/{table}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in BASE_TABLES:
                self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                text = VIEWS[name]
                if _PARTS in text:  # counted first by one job: Spark can't shuffle by a subquery's result
                    text = text.replace(_PARTS, f"CAST({self['part'].count() or 'NULL'} AS BIGINT)")
                self._cache[name] = self.spark.sql(text, **{d: self._argument(name, d) for d in _DEPS[name] if f"{{{d}}}" in text})
        return self._cache[name]

    def _argument(self, view: str, name: str) -> DataFrame:
        if name in _SIDES:
            return _side(self[name])
        return _spread(self[name]) if name == "part" and view in ("product", "catalog") else self[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]


def tables(spark: SparkSession, sf_dir: str) -> FixtureTables:
    ship_package(spark)
    return FixtureTables(spark, sf_dir)


def duckdb_ctes(names=tuple(VIEWS)) -> str:
    """``WITH`` clause defining the requested fixture views (plus dependencies) for DuckDB."""
    order = []

    def visit(n):
        for d in _DEPS.get(n, ()):
            if d in VIEWS:
                visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    fmt = {t: t for t in BASE_TABLES}
    fmt.update({v: v for v in VIEWS})
    parts = [f"{n} AS ({VIEWS[n].format(**fmt)}\n)" for n in order]
    return "WITH " + ",\n".join(parts)
