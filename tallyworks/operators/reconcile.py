"""Totals against components after imputation, and the checks on the result.

Every window covers one (reference, period), at most one row per question of the form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyworks import constants as c
from tallyworks.functions.expressions import exact_sum, not_equal, truthy, unit_window

TOLERANCE = 1e-3


def rescale_total_only(df: DataFrame, total: int = c.TOTAL_QUESTION) -> DataFrame:
    """Components of a total-only return are scaled to add up to the total.

    A zero component sum under a non-zero total cannot be scaled: ``failed_rescale``.
    """
    flagged, is_total = truthy(c.TOTAL_ONLY), F.col(c.QUESTION) == total
    value = F.col(c.TARGET)

    def over_unit(rows):
        some = F.count(F.when(rows, 1)).over(unit_window()) > 0
        amount = exact_sum(F.when(rows, value), unit_window())
        return F.when(some, F.coalesce(amount, F.lit(0.0)))

    sums = df.withColumns({
        "_total": over_unit(flagged & is_total),
        "_components": over_unit(flagged & ~is_total),
    })
    ratio = F.try_divide(F.col("_total"), F.col("_components"))
    failed = (F.col("_components") == 0) & (F.col("_total") != 0)
    return sums.withColumns({
        f"{c.TARGET}_pre_rescale": value,
        "failed_rescale": F.coalesce(failed, F.lit(False)),
        c.TARGET: F.when(flagged & ~is_total & ratio.isNotNull(),
                         ratio * value).otherwise(value),
    }).drop("_total", "_components")


def derive_total(df: DataFrame, total: int = c.TOTAL_QUESTION) -> DataFrame:
    """Totals that were not returned become the sum of the imputed components, marker d."""
    is_total = F.col(c.QUESTION) == total
    not_returned = not_equal(c.MARKER, "r")
    imputed = ~is_total & not_returned & (F.col(c.TOTAL_ONLY) == False)  # noqa: E712
    some = F.count(F.when(imputed, 1)).over(unit_window()) > 0
    amount = F.coalesce(
        exact_sum(F.when(imputed, F.col(c.TARGET)), unit_window()), F.lit(0.0))
    derive = is_total & not_returned
    return (df.withColumn("_derived", F.when(some, amount))
            .withColumns({
                c.TARGET: F.when(derive, F.coalesce(F.col("_derived"), F.col(c.TARGET)))
                .otherwise(F.col(c.TARGET)),
                c.MARKER: F.when(derive, "d").otherwise(F.col(c.MARKER)),
            }).drop("_derived"))


def check_totals(df: DataFrame, total: int = c.TOTAL_QUESTION) -> DataFrame:
    """Totals that differ from the sum of the other questions."""
    is_total = F.col(c.QUESTION) == total
    some = F.count(F.when(~is_total, 1)).over(unit_window()) > 0
    amount = F.coalesce(
        exact_sum(F.when(~is_total, F.col(c.TARGET)), unit_window()), F.lit(0.0))
    return (df.withColumn("components_sum", F.when(some, amount))
            .where(is_total
                   & (F.abs(F.col(c.TARGET) - F.col("components_sum")) >= TOLERANCE))
            .select(c.PERIOD, c.REFERENCE, c.TARGET, "components_sum", "failed_rescale"))


def check_r_before_d(df: DataFrame, total: int = c.TOTAL_QUESTION) -> DataFrame:
    """Components with a derived value that does not follow a returned or derived one."""
    months = Window.partitionBy(c.REFERENCE, c.QUESTION).orderBy(c.PERIOD)
    components = df.where(F.col(c.QUESTION) != total)
    before = F.lag(c.MARKER).over(months)
    fails = (F.col(c.MARKER) == "d") & ~F.coalesce(before.isin("r", "d"), F.lit(False))
    return (components.withColumn("_fails", fails).where("_fails")
            .select(c.REFERENCE, c.QUESTION).distinct())


def check_r_before_d_top5(df: DataFrame, total: int = c.TOTAL_QUESTION) -> DataFrame:
    return check_r_before_d(df, total).orderBy(c.REFERENCE, c.QUESTION).limit(5)
