"""Reload sinks: idempotent, and the window reload removes in-window dates that vanished."""

import datetime as dt
import tempfile

import json
import os

import pytest
from pyspark.sql import functions as F

from planmatch import sinks
from planmatch.sinks import read_table, snapshot_reload, table_exists, window_reload


def rows(spark, data):
    return spark.createDataFrame(data, "D date, V long")


def read(spark, path):
    return sorted((r["D"], r["V"]) for r in read_table(spark, path).collect())


def test_window_reload_idempotent_and_drops_stale(spark):
    path = tempfile.mkdtemp(prefix="reload-") + "/t"
    d = dt.date
    old = rows(spark, [(d(2024, 1, 1), 1), (d(2024, 3, 1), 2), (d(2024, 3, 5), 3)])
    window_reload(old, path, "D", d(2023, 1, 1))
    new = rows(spark, [(d(2024, 3, 1), 20), (d(2024, 3, 2), 21)])
    dropped = window_reload(new, path, "D", d(2024, 2, 1))
    assert dropped == [d(2024, 3, 5)]
    first = read(spark, path)
    assert first == [(d(2024, 1, 1), 1), (d(2024, 3, 1), 20), (d(2024, 3, 2), 21)]
    window_reload(new, path, "D", d(2024, 2, 1))
    assert read(spark, path) == first


def test_snapshot_reload_replaces_only_batch_dates(spark):
    path = tempfile.mkdtemp(prefix="snap-") + "/t"
    d = dt.date
    snapshot_reload(rows(spark, [(d(2024, 1, 1), 1), (d(2024, 1, 2), 2)]), path, "D")
    batch = rows(spark, [(d(2024, 1, 2), 5)])
    snapshot_reload(batch, path, "D")
    snapshot_reload(batch, path, "D")
    assert read(spark, path) == [(d(2024, 1, 1), 1), (d(2024, 1, 2), 5)]
    snapshot_reload(rows(spark, []), path, "D")
    assert read(spark, path) == [(d(2024, 1, 1), 1), (d(2024, 1, 2), 5)]


def test_export_csv_run_folder(spark):
    from planmatch.sinks import export_csv

    base = tempfile.mkdtemp(prefix="csv-")
    root = export_csv({"matched": rows(spark, [(dt.date(2024, 1, 1), 1)])}, base, run_ts="2024-01-01_00-00-00")
    assert root.endswith("run_ts=2024-01-01_00-00-00")
    back = spark.read.option("header", True).csv(root + "/matched").collect()
    assert [(r["D"], r["V"]) for r in back] == [("2024-01-01", "1")]


def test_window_reload_leaves_the_table_when_the_batch_fails_or_starts_too_early(spark):
    path = tempfile.mkdtemp(prefix="reload-") + "/t"
    d = dt.date
    old = [(d(2024, 1, 1), 1), (d(2024, 3, 1), 2)]
    window_reload(rows(spark, old), path, "D", d(2023, 1, 1))
    broken = rows(spark, [(d(2024, 3, 2), 9)]).withColumn("V", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        window_reload(broken, path, "D", d(2024, 2, 1))
    assert read(spark, path) == old
    with pytest.raises(ValueError, match="before the window"):
        window_reload(rows(spark, [(d(2024, 1, 1), 9)]), path, "D", d(2024, 2, 1))
    assert read(spark, path) == old


def test_readers_keep_the_old_table_until_the_switch(spark, monkeypatch):
    """A failure after the write and before the manifest: the old table is read, and the next reload goes through."""
    path = tempfile.mkdtemp(prefix="switch-") + "/t"
    d = dt.date
    old, new = [(d(2024, 1, 1), 1), (d(2024, 3, 1), 2), (d(2024, 3, 5), 3)], [(d(2024, 3, 1), 20)]
    window_reload(rows(spark, old), path, "D", d(2023, 1, 1))
    publish = sinks._publish

    def fails(spark_, path_, number, manifest):
        assert read(spark, path) == old and any(f"reload_version={v}" in os.listdir(path + "/data") for v in manifest["dates"].values())
        raise OSError("lost")

    monkeypatch.setattr(sinks, "_publish", fails)
    with pytest.raises(OSError):
        window_reload(rows(spark, new), path, "D", d(2024, 2, 1))
    assert read(spark, path) == old
    monkeypatch.setattr(sinks, "_publish", publish)
    assert window_reload(rows(spark, new), path, "D", d(2024, 2, 1)) == [d(2024, 3, 5)]
    assert read(spark, path) == [(d(2024, 1, 1), 1), (d(2024, 3, 1), 20)]
    assert sorted((r["D"], r["V"]) for r in read_table(spark, path, back=1).collect()) == old


def test_half_a_manifest_is_no_switch(spark):
    path = tempfile.mkdtemp(prefix="half-") + "/t"
    d = dt.date
    snapshot_reload(rows(spark, [(d(2024, 1, 1), 1)]), path, "D")
    with open(f"{path}/_manifests/{2:012d}.json", "w") as f:
        f.write('{"date_col": "D", "dates": {"2024')
    assert read(spark, path) == [(d(2024, 1, 1), 1)]
    snapshot_reload(rows(spark, [(d(2024, 1, 2), 2)]), path, "D")
    assert read(spark, path) == [(d(2024, 1, 1), 1), (d(2024, 1, 2), 2)]


def test_the_second_of_two_writers_fails(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="race-") + "/t"
    d = dt.date
    snapshot_reload(rows(spark, [(d(2024, 1, 1), 1)]), path, "D")
    stage = sinks._stage

    def other_first(new, *args):
        dates = stage(new, *args)
        monkeypatch.setattr(sinks, "_stage", stage)
        snapshot_reload(rows(spark, [(d(2024, 1, 1), 7)]), path, "D")
        return dates

    monkeypatch.setattr(sinks, "_stage", other_first)
    with pytest.raises(Exception, match="exist"):
        snapshot_reload(rows(spark, [(d(2024, 1, 1), 8)]), path, "D")
    assert read(spark, path) == [(d(2024, 1, 1), 7)]


def test_old_versions_go_and_no_table_is_mistaken(spark):
    path = tempfile.mkdtemp(prefix="old-") + "/t"
    d = dt.date
    for k in range(5):
        snapshot_reload(rows(spark, [(d(2024, 1, 1 + k % 2), k)]), path, "D")
    named = {v for m in os.listdir(path + "/_manifests") if m.endswith(".json") for v in json.load(open(f"{path}/_manifests/{m}"))["dates"].values()}
    assert {n for n in os.listdir(path + "/data") if n.startswith("reload_version=")} == {f"reload_version={v}" for v in named} and len(named) == 3
    assert read(spark, path) == [(d(2024, 1, 1), 4), (d(2024, 1, 2), 3)]
    plain = tempfile.mkdtemp(prefix="plain-") + "/t"
    assert not table_exists(spark, plain)
    rows(spark, [(d(2024, 1, 1), 1)]).write.partitionBy("D").parquet(plain)
    with pytest.raises(ValueError, match="something else"):
        snapshot_reload(rows(spark, [(d(2024, 1, 1), 1)]), plain, "D")
    with pytest.raises(ValueError, match="without D"):
        snapshot_reload(rows(spark, [(None, 1)]), path, "D")
    with pytest.raises(ValueError, match="columns"):
        snapshot_reload(rows(spark, [(d(2024, 1, 1), 1)]).withColumn("W", F.lit(1)), path, "D")
    assert read(spark, path) == [(d(2024, 1, 1), 4), (d(2024, 1, 2), 3)]


def test_one_large_date_is_written_by_several_tasks(spark):
    """Rebalanced: file count by size, not one task a date; small dates get one file each."""
    path = tempfile.mkdtemp(prefix="large-") + "/t"
    big = spark.range(0, 200_000, 1, 8).select(F.lit(dt.date(2024, 1, 1)).alias("D"), F.xxhash64("id").alias("V"))
    small = spark.range(40).select(F.date_add(F.lit(dt.date(2024, 2, 1)), (F.col("id") % 4).cast("int")).alias("D"), F.col("id").alias("V"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    try:
        snapshot_reload(big.unionAll(small), path, "D")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    root = f"{path}/data/{[n for n in os.listdir(path + '/data') if n.startswith("reload_version=")][0]}"
    files = {f: len([n for n in os.listdir(f"{root}/{f}") if n.endswith(".parquet")]) for f in os.listdir(root) if f.startswith("D=")}
    assert 3 <= files["D=2024-01-01"] <= 32 and all(n == 1 for f, n in files.items() if f != "D=2024-01-01")
    assert read_table(spark, path).count() == 200_040


def test_csv_round_trip_keeps_types_nulls_and_quotes(spark):
    base = tempfile.mkdtemp(prefix="csv-")
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 'a "b", c', 1.5, None), (None, "  ", None, 3), (None, None, 0.1, -1)], "D date, S string, X double, N long")
    root = sinks.export_csv({"t": df}, base, run_ts="r")
    assert sorted(map(str, sinks.read_csv_export(spark, root, "t", df.schema).collect())) == sorted(map(str, df.collect()))


def test_headers_and_required_columns(spark):
    from planmatch.sources import catalog as CAT
    from planmatch.sources.extract import require_columns

    padded = spark.createDataFrame([("a", "c1", 1), ("a", "c2", 2)], [" PRODUCTNAME", "SNOPCATEGORY ", "CATALOGPOS"])
    assert CAT.prepare_catalog(padded).columns == ["PRODUCTNAME", "SNOPCATEGORY", "CATALOGPOS", "POS"]
    with pytest.raises(KeyError, match="PRODUCTNAME"):
        CAT.prepare_catalog(spark.createDataFrame([("a",)], ["NAME"]))
    assert require_columns(padded, " PRODUCTNAME") is padded
    bare = CAT.prepare_catalog(spark.createDataFrame([("a",)], ["PRODUCTNAME"]))
    assert bare.first()["SNOPCATEGORY"] is None and bare.first()["POS"] == "a"
