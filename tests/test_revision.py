"""Saved results revised by month, stage tables that size themselves, filters at the scan."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tallyworks import constants as c
from tallyworks.operators import estimation, regions
from tallyworks.sources import sinks
from tallyworks.sources.shared import chosen_folder
from tallyworks.sources.store import RunStore

MONTHS = (202301, 202302, 202303)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(spark, rows):
    return spark.createDataFrame(rows, f"{c.REFERENCE} long, {c.PERIOD} int, {c.TARGET} double")


def values(spark, path):
    return sorted(map(tuple, sinks.read_months(
        spark, path, (c.REFERENCE, c.PERIOD, c.TARGET)).collect()))


def test_only_revised_months_change(spark, tmp_path):
    path = str(tmp_path / "results")
    first = rows_of(spark, [(i, m, 1.0) for i in range(4) for m in MONTHS])
    sinks.revise_months(first, path, MONTHS)
    old = {f: f.stat().st_mtime_ns for f in Path(path).glob("period=202301/*.parquet")}
    again = rows_of(spark, [(i, 202303, 2.0) for i in range(3)])
    for _ in range(2):
        sinks.revise_months(again, path, (202302, 202303))
    assert values(spark, path) == sorted(
        [(i, 202301, 1.0) for i in range(4)] + [(i, 202303, 2.0) for i in range(3)])
    assert {f: f.stat().st_mtime_ns for f in Path(path).glob("period=202301/*.parquet")} == old
    month = sinks.read_months(spark, path).where(F.col(c.PERIOD) == 202303)
    assert month.count() == 3 and "PartitionFilters: [isnotnull(period" in plan(month)


def test_rows_of_other_months_raise(spark, tmp_path):
    path = str(tmp_path / "results")
    sinks.revise_months(rows_of(spark, [(1, 202301, 1.0)]), path, (202301,))
    for bad in ([(1, 202302, 5.0)], [(1, None, 5.0)]):
        with pytest.raises(Exception, match="not revised"):
            sinks.revise_months(rows_of(spark, bad), path, (202301,))
    assert values(spark, path) == [(1, 202301, 1.0)]


def test_buckets_follow_the_size(spark, tmp_path):
    counts, sums = [], []
    for rows in (1_000, 400_000):
        spark.range(rows).select(F.col("id").alias(c.REFERENCE), F.rand(1).alias("x")).write.parquet(
            str(tmp_path / str(rows)))
        table = spark.read.parquet(str(tmp_path / str(rows)))
        store = RunStore(spark, bucket_bytes=1 << 18)
        kept = store.keep(table.repartition(c.REFERENCE), "rows", by=c.REFERENCE)
        counts.append(store.buckets)
        sums.append(kept.count())
        assert "Exchange" not in plan(kept.groupBy(c.REFERENCE).count())
        store.close()
    assert counts[0] == 4 < counts[1] and sums == [1_000, 400_000]


def test_an_oversized_bucket_is_split(spark):
    store = RunStore(spark, bucket_bytes=1 << 16)
    store.buckets = 2  # as if planned from smaller inputs
    many = spark.range(100_000).select(F.col("id").alias(c.REFERENCE), F.rand(2).alias("x"))
    kept = store.keep(many.repartition(c.REFERENCE), "rows", by=c.REFERENCE)
    files = len(kept.inputFiles())
    assert files > store.buckets and kept.count() == 100_000
    fixed = RunStore(spark, buckets=2, bucket_bytes=1 << 16)
    assert len(fixed.keep(many.repartition(c.REFERENCE), "rows", by=c.REFERENCE).inputFiles()) == 2


@pytest.mark.parametrize("warehouse, master, shared", [
    ("file:/home/spark-warehouse", "spark://host:7077", False), ("/tmp/w", "yarn", False),
    ("spark-warehouse", "local-cluster[2,1,1024]", False), ("hdfs://name/w", "yarn", True),
    ("file:/tmp/w", "local[8]", True), ("file:/tmp/w", "local", True)])
def test_folder_is_shared(warehouse, master, shared):
    assert chosen_folder("file:/named/", warehouse, master) == "file:/named"
    if shared:
        assert chosen_folder(None, warehouse, master) == f"{warehouse}/kept"
    else:
        with pytest.raises(ValueError, match="not shared"):
            chosen_folder(None, warehouse, master)


def test_population_is_scanned_once(spark, tmp_path):
    spark.range(500).select(
        F.col("id").alias(c.REFERENCE), F.lit(202301).alias(c.PERIOD),
        (F.col("id") % 5).cast("int").alias(c.CELL), F.lit(2.5).alias(c.AUXILIARY)).write.parquet(
        str(tmp_path / "population"))
    population = spark.read.parquet(str(tmp_path / "population"))
    drawn = spark.createDataFrame([(i, 202301) for i in range(0, 600, 7)] + [(7, 202301)],
                                  f"{c.REFERENCE} long, {c.PERIOD} int")
    counts = estimation.population_counts(population, drawn)
    assert plan(counts).count("FileScan") == 1
    found = {r[c.CELL]: r for r in counts.collect()}
    picked = [i for i in [*range(0, 500, 7), 7]]
    for cell in range(5):
        here = [i for i in picked if i % 5 == cell]
        assert (found[cell].population_count, found[cell].sample_count) == (100, len(here))
        assert found[cell].sample_turnover_sum == 2.5 * len(here)


def test_latest_quarter_reaches_the_scans(spark, tmp_path):
    names = ("design_weight", "outlier_weight", "calibration_factor", c.THOUSANDS)
    spark.range(40).select(
        (F.col("id") % 4).alias(c.REFERENCE), (202300 + F.col("id") % 10 + 1).cast("int").alias(
            c.PERIOD), F.lit(202).alias(c.QUESTION), F.lit("XX").alias("region"),
        *[F.lit(1.0).alias(name) for name in names]).write.parquet(str(tmp_path / "results"))
    spark.range(40).select(
        (F.col("id") % 4).alias(c.REFERENCE), (202300 + F.col("id") % 12 + 1).cast("int").alias(
            c.PERIOD), F.lit(3).alias("employment"), F.lit("XX").alias("region")).write.parquet(
        str(tmp_path / "units"))
    results, units = (spark.read.parquet(str(tmp_path / name)) for name in ("results", "units"))
    latest = regions.rm_table(results, units)
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    text = plan(latest)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "Window" not in text
    assert text.count(f"GreaterThanOrEqual({c.PERIOD},ScalarSubquery") >= 2, text
    months = regions.rm_rows(results)
    turnover = regions.rm_turnover(months, regions.rm_percent(units))
    want = regions.rm_output(turnover, "2023Q4").collect()
    assert latest.collect() == want and len(want) == len(regions.REGION_NAMES)
    assert regions.rm_output(turnover).collect() == want
