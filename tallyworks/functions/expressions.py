"""Column expressions shared by the operators.  All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, Window, WindowSpec, functions as F

from tallyworks import constants as c


def is_in(column: Column | str, values: Iterable) -> Column:
    """Membership that is false, not NULL, for a missing value.

    Written so that it, and its negation, reach the scan as a filter.
    """
    column = F.col(column) if isinstance(column, str) else column
    values = list(values)
    if not values:
        return F.lit(False)
    return column.isNotNull() & column.isin(values)


def truthy(column: Column | str) -> Column:
    """A nullable flag read as false where it is missing."""
    column = F.col(column) if isinstance(column, str) else column
    return column.eqNullSafe(F.lit(True))


def not_equal(column: Column | str, value) -> Column:
    """Inequality that is true for a missing value."""
    column = F.col(column) if isinstance(column, str) else column
    return ~column.eqNullSafe(F.lit(value))


def unit_window() -> WindowSpec:
    """All rows of a (reference, period): at most one per question on the form."""
    return Window.partitionBy(*c.UNIT)


def amount_parts(column: Column) -> tuple[Column, Column]:
    """Wholes and billionths of an amount, as long numbers to be added apart.

    NaN, and amounts of 9e18 or more, raise.
    """
    amount = F.when(F.isnan(column) | (F.abs(column) >= 9e18), F.raise_error(
        F.concat(F.lit("amount that cannot be added: "), column.cast("string"))).cast("double")
    ).otherwise(column.cast("double"))
    whole = amount.cast("long")
    return whole, F.floor((amount - whole) * 1e9 + 0.5)


def joined_parts(wholes: Column, billionths: Column) -> Column:
    return wholes.cast("double") + billionths.cast("double") / 1e9


def exact_sum(column: Column, over: WindowSpec | None = None) -> Column:
    """Sum of amounts, the same in whatever order its parts arrive.

    Partial sums arrive in any order, and in another order again when an executor is lost.
    Wholes and billionths of the amounts are added apart as long numbers, so a published figure
    stays the same, which floating-point addition does not give.  An amount is off by half a
    billionth at most, and one over four million by nothing, as its own last digit is larger.
    NaN, amounts of 9e18 or more and sums beyond a long raise.
    """
    sums = [F.sum(part) for part in amount_parts(column)]
    return joined_parts(*(sums if over is None else [part.over(over) for part in sums]))


def exact_variance(column: Column) -> tuple[Column, Column, Column]:
    """Sample variance, count and mean of a group's amounts, the same in whatever order.

    Count, sums and sums of products of wholes and billionths are whole numbers, which partial
    aggregates add without loss; n * sum(x^2) - sum(x)^2 is taken apart by wholes and
    billionths before anything is rounded.  A variance is missing for less than two amounts.
    Sums beyond 38 digits raise.
    """
    whole, part = (x.cast("decimal(19,0)") for x in amount_parts(column))
    n = F.count(column)
    count = n.cast("decimal(19,0)")
    one, two = F.sum(whole), F.sum(part)

    def spread(x: Column, y: Column) -> Column:
        wide = "decimal(38,0)"
        return (count * F.sum(x * y) - F.sum(x).cast(wide) * F.sum(y).cast(wide)).cast("double")

    apart = (spread(whole, whole) + 2 * spread(whole, part) / 1e9
             + spread(part, part) / 1e9 / 1e9)
    number = n.cast("double")
    variance = F.when(n > 1, apart / number / (number - 1))
    return variance, n, F.try_divide(joined_parts(one, two), number)


def rounded(column: Column, places: int) -> Column:
    """Rounded as a decimal number, halves away from zero, once noise under a billionth is off."""
    return F.round(column.cast("decimal(38,9)"), places).cast("double")


def month_index(period: Column) -> Column:
    """yyyymm as a running month number (year * 12 + month)."""
    return (F.floor(period / 100) * 12 + period % 100).cast("int")


def period_of(month: Column) -> Column:
    """Inverse of :func:`month_index`."""
    return (F.floor((month - 1) / 12) * 100 + (month - 1) % 12 + 1).cast("int")


def quarter_label(period: Column) -> Column:
    """yyyymm as yyyyQn."""
    year = F.floor(period / 100).cast("string")
    quarter = F.floor((period % 100 + 2) / 3).cast("string")
    return F.concat(year, F.lit("Q"), quarter)


def quarter_periods(quarter: str) -> list[int]:
    """Months of a yyyyQn, to filter on the stored period."""
    year, number = int(quarter[:4]), int(quarter[5])
    return [year * 100 + 3 * number - back for back in (2, 1, 0)]


def month_label(period: int) -> str:
    """yyyymm as yyyyMON."""
    return f"{period // 100}{c.MONTH_NAMES[period % 100 - 1]}"


def size_band(cell: Column) -> Column:
    """Last digit of the cell number."""
    return (cell % 10).cast("int")


def annual_to_monthly(annual_thousands: Column) -> Column:
    """Yearly thousands of pounds as monthly pounds."""
    return annual_thousands * 1000 / 12


def pounds_thousands(question: Column, value: Column, questions: Iterable[int]) -> Column:
    return F.when(is_in(question, questions), value / 1000).otherwise(value)


def grossed(value: Column) -> Column:
    """Value times design weight, outlier weight and calibration factor."""
    return (value * F.col("design_weight") * F.col("outlier_weight")
            * F.col("calibration_factor"))


def int_array(values: Iterable[int]) -> Column:
    values = list(values)
    return F.array(*[F.lit(int(v)) for v in values]) if values else F.array().cast("array<int>")
