"""Figures that neither row order, partitions nor threads decide."""

from __future__ import annotations

import math
import random
import statistics
from decimal import Decimal

import pytest
from compare import connect, difference
from oracle.queries import ORACLES
from pyspark.sql import functions as F
from tallyworks import constants as c
from tallyworks.functions.expressions import exact_variance, rounded
from tallyworks.operators.outliers import total_outlier_weight
from tallyworks.operators.outputs import _complete, sizeband
from tallyworks.plans.catalog import QUERIES

FRAGILE = ("total_outlier_weight", "winsorised_value", "detect_outlier", "results_table",
           "standard_errors")
SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("weights, want", [
    ([0.999999999999999, 1.0, 1.0], 1.0), ([1.0, 1.0, 1.0000000000000002], 1.0),
    ([0.99999999, 1.0, 1.0], 0.9999999966666667), ([None, 1.0, 1.0], 1.0),
    ([None, 0.5, 1.0], 0.5), ([0.5, 1.5, 1.0], 1.0)])
def test_total_weight_whatever_the_order(spark, weights, want):
    """The mean of the second kind is 1 in some orders only if it is added as doubles."""
    for seed in range(6):
        rows = [(1, 202001, question, 10.0, weight)
                for question, weight in zip((201, 202, 211), weights)]
        rows.append((1, 202001, 290, 30.0, None))
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, f"{c.REFERENCE} long, {c.PERIOD} int, "
                                   f"{c.QUESTION} int, {c.TARGET} double, outlier_weight double")
        total = total_outlier_weight(df.repartition(1 + seed)).where(F.col(c.QUESTION) == 290)
        assert total.first().outlier_weight == pytest.approx(want, abs=1e-12)


def test_variance_is_exact(spark):
    draw = random.Random(5)
    values = [draw.uniform(-1e6, 1e6) for _ in range(500)] + [1e9, -1e9, 0.1, 0.2]
    exact = [Decimal(round(Decimal(v) * 10**9)) for v in values]
    want = float(statistics.variance(exact) / 10**18)
    seen = set()
    for parts in (1, 3, 31):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        variance, n, mean = exact_variance(F.col("v"))
        row = df.agg(variance.alias("v"), n.alias("n"), mean.alias("m")).first()
        assert row.n == len(values) and math.isclose(row.v, want, rel_tol=1e-14)
        seen.add(tuple(row))
    assert len(seen) == 1


def test_variance_of_few(spark):
    variance, n, mean = exact_variance(F.col("v"))
    moments = [variance.alias("v"), n.alias("n"), mean.alias("m")]
    rows = [("none", None), ("one", 3.0), ("two", 1.0), ("two", 1.001), ("gap", 2.0), ("gap", None)]
    found = {r.k: tuple(r)[1:] for r in spark.createDataFrame(rows, "k string, v double")
             .groupBy("k").agg(*moments).collect()}
    assert found["none"] == (None, 0, None) and found["one"] == (None, 1, 3.0)
    assert found["gap"] == (None, 1, 2.0)
    assert found["two"][0] == pytest.approx(5e-7, abs=1e-15)


@pytest.mark.parametrize("value, want", [(0.0005, 0.001), (2.0015, 2.002), (1.00049999, 1.0),
                                         (-0.0005, -0.001), (1.0004999999999999, 1.001)])
def test_halves_are_rounded_away_from_zero(spark, value, want):
    df = spark.range(1).select(rounded(F.lit(value), 3).alias("x"))
    assert df.first().x == want


@pytest.mark.parametrize("name", FRAGILE)
def test_same_by_partitions_and_threads(spark, name):
    con = connect(SF_DIR)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, threads in ((3, 1), (31, 4)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            con.execute(f"SET threads = {threads}")
            assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_completion_reads_cells_once(spark, tmp_path):
    cells = [("2020Q1", 1, 5.0), ("2020Q1", 2, 6.0), ("2020Q2", 1, 7.0), (None, 1, 9.0)]
    df = spark.createDataFrame(cells, "quarter string, sizeband int, x double")
    found = {tuple(r)[:2]: r.x for r in _complete(df, ["quarter", "sizeband"]).collect()}
    assert found == {("2020Q1", 1): 5.0, ("2020Q1", 2): 6.0, ("2020Q2", 1): 7.0,
                     ("2020Q2", 2): None}
    assert _complete(df.limit(0), ["quarter", "sizeband"]).count() == 0
    rows = spark.createDataFrame(
        [(202001, 201, 11, 2.0, 1.0, 1.0, 1.0)],
        f"{c.PERIOD} int, {c.QUESTION} int, {c.CELL} int, {c.TARGET} double, "
        "design_weight double, outlier_weight double, calibration_factor double")
    rows.write.parquet(str(tmp_path / "results"))
    plan = sizeband(spark.read.parquet(str(tmp_path / "results")))._jdf.queryExecution()
    assert plan.executedPlan().toString().count("FileScan") == 1
