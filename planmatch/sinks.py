"""Idempotent reloads of date-partitioned parquet tables by version switch, and CSV exports.

A table is a folder of versions (``data/reload_version=<id>/<date_col>=<date>/``) and of numbered manifests, each of which names
the version that holds every date.  A reload writes its whole batch as a new version and then publishes one new
manifest; readers see the old table until that one file is complete, and the new one from then on.

* ``window_reload``   dates >= ``start`` are the batch's afterwards, those that it no longer has are gone; a batch
                      with dates before ``start`` is refused, so nothing outside the window changes.
* ``snapshot_reload`` replaces exactly the snapshot dates in the batch; an empty batch changes nothing.
* ``read_table``      the table as last published (or an earlier version that is still kept).

A batch with null dates is refused.  Running the same batch twice leaves the same rows.  Two writers at a time:
the second to publish fails, and its batch leaves no trace.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFESTS, DATA, VERSION = "_manifests", "data", "reload_version"
#: Manifests, the current one included, whose data a reload keeps.
KEEP = 2
NULL_DATE = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _manifest(spark: SparkSession, path: str, number: int) -> dict | None:
    """One manifest; None if its writer did not finish it."""
    fs, p = _fs(spark, f"{path}/{MANIFESTS}/{number:012d}.json")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except ValueError:
        return None
    finally:
        stream.close()


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n[:-5]) for n in _names(spark, f"{path}/{MANIFESTS}") if n.endswith(".json")]


def _current(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """The last number in use, and the last complete manifest."""
    numbers = _numbers(spark, path)
    for n in reversed(numbers):
        found = _manifest(spark, path, n)
        if found is not None:
            return numbers[-1], found
    return (numbers[-1] if numbers else 0), None


def table_exists(spark: SparkSession, path: str) -> bool:
    return _current(spark, path.rstrip("/"))[1] is not None


def read_table(spark: SparkSession, path: str, back: int = 0) -> DataFrame:
    """The table as published last, or ``back`` publications before."""
    path = path.rstrip("/")
    known = [m for m in (_manifest(spark, path, n) for n in reversed(_numbers(spark, path)[-(back + KEEP + 8):])) if m is not None]
    if len(known) <= back:
        raise FileNotFoundError(f"no published table at {path}")
    m = known[back]
    schema = T.StructType.fromJson(m["schema"])
    folders = [f"{path}/{DATA}/{VERSION}={v}/{m['date_col']}={d}" for d, v in sorted(m["dates"].items())]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/{DATA}").parquet(*folders).select(*schema.names)


def _stage(new: DataFrame, path: str, date_col: str, version: str) -> list[str]:
    """Writes the batch as a version of its own; its dates.

    Rebalanced by date: one or few files a small date, and as many tasks as its size asks for a large one.
    """
    root = f"{path}/{DATA}/{VERSION}={version}"
    new.hint("rebalance", date_col).write.partitionBy(date_col).parquet(root)
    dates = [n.split("=", 1)[1] for n in _names(new.sparkSession, root) if n.startswith(f"{date_col}=")]
    if NULL_DATE in dates:
        raise ValueError(f"the batch has rows without {date_col}")
    return dates


def _publish(spark: SparkSession, path: str, number: int, manifest: dict) -> None:
    """Creates manifest ``number``; fails if another writer was first."""
    fs, p = _fs(spark, f"{path}/{MANIFESTS}/{number:012d}.json")
    out = fs.create(p, False)
    try:
        out.write(bytearray(json.dumps(manifest).encode()))
    finally:
        out.close()


def _reload(new: DataFrame, path: str, date_col: str, merge) -> list[str]:
    """Stages ``new``, publishes ``merge(old dates, new dates)``; returns the dates that the table had and has no more."""
    spark, path = new.sparkSession, path.rstrip("/")
    if not isinstance(new.schema[date_col].dataType, T.DateType):
        raise ValueError(f"{date_col} is not a date")
    number, old = _current(spark, path)
    if old is None and _names(spark, path) not in ([], [DATA], [MANIFESTS], sorted([DATA, MANIFESTS])):
        raise ValueError(f"{path} holds something else than a table of versions")
    schema = json.loads(new.schema.json())
    for field in schema["fields"]:
        field["nullable"] = True
    if old is not None and old["dates"] and [(f["name"], f["type"]) for f in old["schema"]["fields"]] != [(f["name"], f["type"]) for f in schema["fields"]]:
        raise ValueError("the batch's columns are not the table's")
    version = uuid.uuid4().hex
    try:
        dates = _stage(new, path, date_col, version)
        before = old["dates"] if old else {}
        after = merge(before, {d: version for d in dates})
        _publish(spark, path, number + 1, {"date_col": date_col, "schema": schema, "dates": after})
    except Exception:
        _delete(spark, f"{path}/{DATA}/{VERSION}={version}")  # a failure up to here leaves the table as it was
        raise
    vacuum(spark, path)
    return sorted(set(before) - set(after))


def vacuum(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Removes what only manifests before the last ``keep`` name, and those manifests.

    Versions that no manifest names may belong to a writer that has not published yet; they stay.
    """
    path = path.rstrip("/")
    numbers = _numbers(spark, path)
    old, kept = numbers[:-keep], [m for m in (_manifest(spark, path, n) for n in numbers[-keep:]) if m]
    if not kept:
        return
    needed = {(d, v) for m in kept for d, v in m["dates"].items()}
    versions = {v for _, v in needed}
    for n in old:
        m = _manifest(spark, path, n) or {"dates": {}}
        for d, v in m["dates"].items():
            if (d, v) not in needed:
                _delete(spark, f"{path}/{DATA}/{VERSION}={v}/{m['date_col']}={d}")
        for v in set(m["dates"].values()) - versions:
            _delete(spark, f"{path}/{DATA}/{VERSION}={v}")
        _delete(spark, f"{path}/{MANIFESTS}/{n:012d}.json")


def window_reload(new: DataFrame, path: str, date_col: str, start) -> list:
    """Make the table's rows with ``date_col >= start`` equal to ``new``. Returns dropped dates."""
    start = start.isoformat()[:10] if isinstance(start, (_dt.date, _dt.datetime)) else str(start)[:10]

    def merge(old: dict, batch: dict) -> dict:
        early = min(batch, default=start)
        if early < start:
            raise ValueError(f"the batch has rows of {early}, before the window's start {start}")
        return {d: v for d, v in old.items() if d < start} | batch

    return [_dt.date.fromisoformat(d) for d in _reload(new, path, date_col, merge)]


def snapshot_reload(new: DataFrame, path: str, date_col: str = "INVENTORYDATE") -> None:
    """Replace exactly the snapshot dates present in ``new``."""
    _reload(new, path, date_col, lambda old, batch: old | batch)


#: Quotes are doubled and spaces kept, as other CSV readers expect.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def export_csv(frames: dict, base_dir: str, run_ts: str | None = None) -> str:
    """Write each frame as header CSV under ``base_dir/run_ts=<ts>/<name>``."""
    if run_ts is None:
        run_ts = _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d_%H-%M-%S")
    root = f"{base_dir.rstrip('/')}/run_ts={run_ts}"
    for name, df in frames.items():
        df.write.mode("overwrite").options(**CSV).csv(f"{root}/{name}")
    return root


def read_csv_export(spark: SparkSession, root: str, name: str, schema) -> DataFrame:
    """One frame of an export, with the columns and types it was written with; an empty text comes back as null."""
    return spark.read.schema(schema).options(**CSV).option("enforceSchema", False).csv(f"{root}/{name}")
