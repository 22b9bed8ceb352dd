"""Regional split of repair and maintenance work by local-unit employment.

The eleven regions are columns of one aggregate, not eleven passes over the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyworks import constants as c
from tallyworks.functions.expressions import (
    exact_sum, grossed, is_in, quarter_label, quarter_periods,
)
from tallyworks.functions.joins import by_merge

REGION_NAMES = tuple(c.REGIONS)


def column_name(measure: str, region: str) -> str:
    return f"{measure}_{region}"


def rm_regional_employment(units: DataFrame) -> DataFrame:
    """Employment per region for each (reference, period); missing without a unit there.

    A unit list is reduced map-side before its shuffle, so a reference with very many local
    units costs no more than any other.
    """
    return units.groupBy(*c.UNIT).agg(*[
        F.sum(F.when(F.col("region").isin(*codes), F.col("employment")))
        .alias(column_name("employment", region)) for region, codes in c.REGIONS.items()])


def rm_total_employment(units: DataFrame) -> DataFrame:
    return units.groupBy(*c.UNIT).agg(F.sum("employment").alias("total_employment"))


def rm_percent(units: DataFrame) -> DataFrame:
    """Share of each region in the employment of a unit."""
    sums = units.groupBy(*c.UNIT).agg(
        F.sum("employment").alias("total_employment"),
        *[F.sum(F.when(F.col("region").isin(*codes), F.col("employment")))
          .alias(column_name("employment", region)) for region, codes in c.REGIONS.items()])
    return sums.select(*c.UNIT, *[
        F.try_divide(F.col(column_name("employment", region)).cast("double"),
                     F.col("total_employment")).alias(column_name("percentage", region))
        for region in REGION_NAMES])


def rm_fill_own_region(df: DataFrame) -> DataFrame:
    """A unit without local units in its own region counts fully there."""
    return df.withColumns({
        column_name("percentage", region): F.when(
            F.col(column_name("percentage", region)).isNull() & is_in("region", codes),
            1.0).otherwise(F.col(column_name("percentage", region)))
        for region, codes in c.REGIONS.items()})


def rm_rows(results: DataFrame, questions: Sequence[int] = tuple(c.REPAIR_QUESTIONS)) -> DataFrame:
    """Grossed turnover of the repair and maintenance questions."""
    return results.where(is_in(c.QUESTION, questions)).select(
        *c.CELL_KEY, "region", grossed(F.col(c.THOUSANDS)).alias("gross_turnover_uk"))


def rm_turnover(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """Turnover of each row split over the regions."""
    split = rm_fill_own_region(rows.join(by_merge(shares), list(c.UNIT), "left"))
    return split.withColumns({
        column_name("turnover", region):
            F.col(column_name("percentage", region)) * F.col("gross_turnover_uk")
        for region in REGION_NAMES})


def in_quarter(rows: DataFrame, quarter: str | None = None) -> Column:
    """Whether a month is of the quarter, of the latest one ``rows`` hold unless it is named.

    The first month of the latest quarter is a scalar subquery, so that it becomes a literal
    before the scan and is pushed down like a named quarter.
    """
    if quarter is not None:
        return is_in(c.PERIOD, quarter_periods(quarter))
    last = F.max(c.PERIOD)
    first = rows.agg((last - (last % 100 - 1) % 3).cast("int").alias("first")).scalar()
    return F.col(c.PERIOD) >= first


def rm_table(results: DataFrame, units: DataFrame, quarter: str | None = None) -> DataFrame:
    """Repair and maintenance work of one quarter by region, from results and local units.

    Both are filtered to the quarter at their scans, before shares are taken and joined.
    """
    rows = rm_rows(results)
    months = in_quarter(rows, quarter)
    turnover = rm_turnover(rows.where(months), rm_percent(units.where(months)))
    return _by_region(turnover)


def rm_output(turnover: DataFrame, quarter: str | None = None,
              questions: Mapping[int, str] = c.REPAIR_QUESTIONS) -> DataFrame:
    """One quarter, the latest unless named: a row per region, a column per question."""
    return _by_region(turnover.where(in_quarter(turnover, quarter)), questions)


def _by_region(turnover: DataFrame,
               questions: Mapping[int, str] = c.REPAIR_QUESTIONS) -> DataFrame:
    rows = turnover.withColumn("quarter", quarter_label(F.col(c.PERIOD)))
    sums = rows.groupBy("quarter", c.QUESTION).agg(*[
        exact_sum(F.col(column_name("turnover", region))).alias(region)
        for region in REGION_NAMES])
    long = sums.unpivot(["quarter", c.QUESTION], list(REGION_NAMES), "region", "turnover")
    wide = long.groupBy("quarter", "region").agg(*[
        F.coalesce(F.max(F.when(F.col(c.QUESTION) == question, F.col("turnover"))),
                   F.lit(0.0)).alias(name)
        for question, name in questions.items()])
    rank = F.array_position(F.array(*[F.lit(r) for r in REGION_NAMES]), F.col("region"))
    return wide.orderBy("quarter", rank)


def quarterly_extract(results: DataFrame, regions: DataFrame, quarter: str,
                      questions: Sequence[int] = tuple(c.REPAIR_QUESTIONS)) -> DataFrame:
    """Grossed target of one quarter per region name; absent cells stay missing.

    ``regions`` maps ``region_code`` to ``region_name``, at most one row per code.
    """
    rows = results.where(
        is_in(c.QUESTION, questions) & is_in(c.PERIOD, quarter_periods(quarter)),
    ).withColumn("quarter", quarter_label(F.col(c.PERIOD)))
    named = rows.join(
        regions.select(F.col("region_code").alias("region"), "region_name"), "region")
    value = grossed(F.col(c.TARGET))
    wide = named.groupBy("quarter", "region_name").agg(*[
        exact_sum(F.when(F.col(c.QUESTION) == question, value)).alias(str(question))
        for question in questions])
    rank = F.array_position(F.array(*[F.lit(r) for r in REGION_NAMES]), F.col("region_name"))
    return wide.orderBy("quarter", rank)
