"""Winsorisation and outlier weights."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tallyworks import constants as c
from tallyworks.functions.expressions import exact_sum, is_in, truthy, unit_window
from tallyworks.functions.joins import by_partition

STRATUM = (c.QUESTION, c.PERIOD, c.CELL)


def join_l_values(panel: DataFrame, classifications: DataFrame,
                  l_values: DataFrame) -> DataFrame:
    """Classification of the unit and its L value, missing where none is listed."""
    sics = classifications.select(
        F.col("sic_5_digit").cast("string").alias(c.SIC), "classification")
    values = l_values.select("classification", c.QUESTION, "l_value")
    return panel.join(sics, [c.SIC], "left").join(
        values, ["classification", c.QUESTION], "left")


def stratum_ratios(df: DataFrame) -> DataFrame:
    """Weighted target and auxiliary per (questioncode, period, cell)."""
    weight = F.col("design_weight")
    return df.groupBy(*STRATUM).agg(
        exact_sum(weight * F.col(c.TARGET)).alias("_target"),
        exact_sum(weight * F.col(c.AUXILIARY)).alias("_auxiliary"),
    ).select(*STRATUM, F.try_divide("_target", "_auxiliary").alias("_ratio"))


def winsorise(df: DataFrame, total: int = c.TOTAL_QUESTION, keep=None) -> DataFrame:
    """One-sided winsorisation under a ratio model; total rows keep a missing weight.

    Stratum sums are aggregated and joined back rather than windowed, as a stratum may hold
    much of the panel.  ``keep`` stores that table so that its size is known.
    """
    ratios = stratum_ratios(df.where(F.col(c.QUESTION) != total))
    if keep is not None:
        ratios = keep(ratios, "stratum_ratios")
    value, level = F.col(c.TARGET), F.col("l_value")
    spread = F.col("design_weight") * F.col("calibration_factor")
    rows = df.join(ratios, list(STRATUM), "left").withColumns({
        "nw_ag_flag": truthy("is_census") | F.coalesce(spread <= 1, F.lit(False)),
        "predicted_unit_value": F.col(c.AUXILIARY) * F.col("_ratio"),
    })
    rows = rows.withColumn(
        "ratio_estimation_treshold",
        F.when(~F.col("nw_ag_flag"),
               F.col("predicted_unit_value") + level / (spread - 1)))
    threshold = F.col("ratio_estimation_treshold")
    trimmed = value / spread + (1 - 1 / spread) * threshold
    rows = rows.withColumn(
        "new_target_variable",
        F.when(F.col("nw_ag_flag"), value)
        .when(threshold.isNotNull(), F.when(value <= threshold, value).otherwise(trimmed)))
    weight = (F.when(F.col("nw_ag_flag") | (value == 0), 1.0)
              .otherwise(F.try_divide(F.col("new_target_variable"), value)))
    is_total = F.col(c.QUESTION) == total
    worked = ("nw_ag_flag", "predicted_unit_value", "ratio_estimation_treshold",
              "new_target_variable")
    return rows.withColumn("outlier_weight", F.when(~is_total, weight)).withColumns(
        {name: F.when(~is_total, F.col(name)) for name in worked}).drop("_ratio")


def total_outlier_weight(df: DataFrame, components: Iterable[int] = c.COMPONENTS,
                         total: int = c.TOTAL_QUESTION) -> DataFrame:
    """Outlier weight of a total: 1 if no component was trimmed, else the trimmed share.

    No component was trimmed if the weights, to the billionth, add up to their number: added
    as whole numbers, so that row order cannot decide it, and a weight that is off 1 by the
    last digits of a division counts as 1.  A component without a weight (no L value listed)
    is left out of that test and of the trimmed sum, so its share of the total is trimmed.
    """
    is_component = is_in(c.QUESTION, components)
    weight, value = F.col("outlier_weight"), F.col(c.TARGET)
    weights = F.when(is_component, weight)
    untrimmed = exact_sum(weights, unit_window()) == F.count(weights).over(unit_window())
    some = F.count(F.when(is_component, 1)).over(unit_window()) > 0
    kept = F.coalesce(
        exact_sum(F.when(is_component, weight * value), unit_window()), F.lit(0.0))
    return (df.withColumns({"_untrimmed": untrimmed, "_kept": F.when(some, kept)})
            .withColumn("outlier_weight",
                        F.when(F.col(c.QUESTION) != total, weight)
                        .when(F.col("_untrimmed") | (weight == 1), 1.0)
                        .otherwise(F.try_divide(F.col("_kept"), value)))
            .drop("_untrimmed", "_kept"))


def manual_outlier_weight(df: DataFrame, manual: DataFrame | None) -> DataFrame:
    """Weights set by hand replace computed ones."""
    if manual is None:
        return df
    by_hand = manual.select(
        *c.CELL_KEY, F.col("outlier_weight").cast("double").alias("_by_hand"))
    return (df.join(by_partition(by_hand), list(c.CELL_KEY), "left")
            .withColumn("outlier_weight", F.coalesce("_by_hand", "outlier_weight"))
            .drop("_by_hand"))


def winsorised_value(df: DataFrame) -> DataFrame:
    return df.withColumn("winsorised_value", F.col("outlier_weight") * F.col(c.TARGET))


def detect_outlier(df: DataFrame, classifications: DataFrame, l_values: DataFrame,
                   manual: DataFrame | None = None,
                   components: Iterable[int] = c.COMPONENTS,
                   total: int = c.TOTAL_QUESTION, keep=None) -> DataFrame:
    rows = winsorise(join_l_values(df, classifications, l_values), total, keep)
    rows = total_outlier_weight(rows, components, total)
    return winsorised_value(manual_outlier_weight(rows, manual))
