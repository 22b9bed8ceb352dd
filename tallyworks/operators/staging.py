"""Row rules and flags that prepare returns for imputation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallyworks import constants as c
from tallyworks.functions.expressions import (
    annual_to_monthly, exact_sum, is_in, not_equal, truthy, unit_window,
)
from tallyworks.functions.joins import by_merge
from tallyworks.settings import SurveySettings


def split_questions(responses: DataFrame, removed: Iterable[int]) -> tuple[DataFrame, DataFrame]:
    """Rows to process, and rows of the questions kept aside."""
    aside = is_in(c.QUESTION, removed)
    return responses.where(~aside), responses.where(aside)


def drop_routing_questions(unprocessed: DataFrame) -> DataFrame:
    return unprocessed.where(~is_in(c.QUESTION, c.ROUTING_QUESTIONS))


def masked_replace(df: DataFrame, column: str, mask: Column, value=None) -> DataFrame:
    """Overwrite ``column`` where the boolean ``mask`` holds."""
    if dict(df.select(mask.alias("mask")).dtypes)["mask"] != "boolean":
        raise ValueError(f"mask for {column} is not boolean")
    kind = dict(df.dtypes)[column]
    return df.withColumn(
        column, F.when(mask, F.lit(value).cast(kind)).otherwise(F.col(column)))


def nil_to_zero(df: DataFrame, nil_statuses: Iterable[str] = c.NIL_STATUSES) -> DataFrame:
    return df.withColumn(
        c.TARGET, F.when(is_in("status", nil_statuses), 0.0).otherwise(F.col(c.TARGET)))


def null_total_only_components(df: DataFrame, total: int = c.TOTAL_QUESTION) -> DataFrame:
    """Zero components of a total-only return become missing, to be imputed."""
    hit = (truthy(c.TOTAL_ONLY) & not_equal(c.QUESTION, total)
           & F.coalesce(F.col(c.TARGET) == 0, F.lit(False)) & ~truthy("skipped_question"))
    return (df.withColumn("q290_component_set_null", hit)
            .withColumn(c.TARGET, F.when(~F.col("q290_component_set_null"), F.col(c.TARGET))))


def monthly_auxiliary(df: DataFrame) -> DataFrame:
    return df.withColumn(c.MONTHLY_AUXILIARY, annual_to_monthly(F.col(c.AUXILIARY)))


def refill_auxiliary(df: DataFrame) -> DataFrame:
    """Rows added after staging get their monthly auxiliary."""
    return df.withColumn(
        c.MONTHLY_AUXILIARY,
        F.coalesce(F.col(c.MONTHLY_AUXILIARY), annual_to_monthly(F.col(c.AUXILIARY))))


def imputation_class(df: DataFrame, bands: Mapping, column: str = c.CELL,
                     output: str = c.CLASS, closed: str = "both") -> DataFrame:
    """Label of the band that holds ``column``; a value outside every band is an error."""
    if any(len(band) != 2 for band in bands.values()):
        raise ValueError(f"{dict(bands)}: each band needs a lower and an upper bound")
    if closed not in ("both", "left", "right", "neither"):
        raise ValueError(f"closed={closed} is not known")
    value = F.col(column)
    label = None
    for name, (low, high) in bands.items():
        above = value >= low if closed in ("both", "left") else value > low
        below = value <= high if closed in ("both", "right") else value < high
        step = (above & below, F.lit(float(name)))
        label = F.when(*step) if label is None else label.when(*step)
    problem = F.concat(F.lit(f"{column} outside the bands: "),
                       F.coalesce(value.cast("string"), F.lit("missing")))
    return df.withColumn(output, label.otherwise(F.raise_error(problem).cast("double")))


def nonresponse_units(contributors: DataFrame, statuses: Iterable[str]) -> DataFrame:
    return contributors.where(is_in("status", statuses))


def check_nonresponse_in_responses(
        responses: DataFrame, contributors: DataFrame,
        statuses: Iterable[str] = c.NON_RESPONSE_STATUSES) -> DataFrame:
    """Units in a non-response status that nevertheless have answers."""
    return (nonresponse_units(contributors, statuses).select(*c.UNIT)
            .join(by_merge(responses), list(c.UNIT), "left_semi"))


def exclude_nonresponse(responses: DataFrame, contributors: DataFrame,
                        statuses: Iterable[str] = c.NON_RESPONSE_STATUSES) -> DataFrame:
    return responses.join(
        by_merge(nonresponse_units(contributors, statuses)), list(c.UNIT), "left_anti")


def excluded_report(responses: DataFrame, contributors: DataFrame,
                    statuses: Iterable[str] = c.NON_RESPONSE_STATUSES) -> DataFrame:
    units = nonresponse_units(contributors, statuses).select(*c.UNIT, "status")
    return responses.join(by_merge(units), list(c.UNIT)).select(
        c.REFERENCE, c.PERIOD, c.QUESTION, "status", c.TARGET)


def frozen_split(responses: DataFrame, contributors: DataFrame,
                 settings: SurveySettings) -> tuple[DataFrame, DataFrame]:
    """Answers to keep, and answers of units in error with their value as ``live_*``.

    A live run keeps everything.  A frozen run treats units in error as non-response,
    except in the back-data month.
    """
    live = F.col(c.TARGET).alias(f"live_{c.TARGET}")
    columns = (c.REFERENCE, c.PERIOD, c.QUESTION, live)
    if settings.state == "live":
        return responses, responses.where(F.lit(False)).select(*columns)
    errors = by_merge(contributors.where(
        is_in("statusencoded", settings.error_codes)
        & not_equal(c.PERIOD, settings.backdata_period)).select(*c.UNIT))
    return (responses.join(errors, list(c.UNIT), "left_anti"),
            responses.join(errors, list(c.UNIT), "left_semi").select(*columns))


def panel_full_outer(contributors: DataFrame, frame: DataFrame) -> DataFrame:
    """Contributors with the sample frame; columns of the same name get a suffix."""
    clash = (set(contributors.columns) & set(frame.columns)) - set(c.UNIT)
    left = contributors.withColumnsRenamed({name: f"{name}_contributor" for name in clash})
    right = frame.withColumnsRenamed({name: f"{name}_frame" for name in clash})
    return left.join(by_merge(right), list(c.UNIT), "full")


def attach_contributors(rows: DataFrame, contributors: DataFrame) -> DataFrame:
    return rows.join(by_merge(contributors), list(c.UNIT), "left")


def _clear(statuses: Iterable[str]) -> Column:
    return is_in("status", statuses)


def total_only_condition(total: int, statuses: Iterable[str]) -> Column:
    """A clear unit whose total is given while its components are zero or absent."""
    is_total, value = F.col(c.QUESTION) == total, F.col(c.TARGET)
    clear = _clear(statuses)
    has_total = F.count(F.when(is_total, 1)).over(unit_window()) > 0
    has_other = F.count(F.when(~is_total, 1)).over(unit_window()) > 0
    total_sum = F.coalesce(exact_sum(F.when(is_total, value), unit_window()), F.lit(0.0))
    other_sum = F.coalesce(exact_sum(F.when(~is_total, value), unit_window()), F.lit(0.0))
    return clear & has_total & (~has_other | ((other_sum == 0) & (total_sum != 0)))


def total_zero_condition(total: int, statuses: Iterable[str]) -> Column:
    """A clear unit that answered nothing but a zero total."""
    value = F.col(c.TARGET)
    only_total = F.count(F.when(not_equal(c.QUESTION, total), 1)).over(unit_window()) == 0
    no_missing = F.count(F.when(value.isNull(), 1)).over(unit_window()) == 0
    zero = F.coalesce(exact_sum(value, unit_window()) == 0, F.lit(False))
    return _clear(statuses) & only_total & no_missing & zero


def flag_total_only(responses: DataFrame, contributors: DataFrame,
                    total: int = c.TOTAL_QUESTION,
                    statuses: Iterable[str] = c.CLEAR_STATUSES) -> DataFrame:
    return (responses.join(by_merge(contributors.select(*c.UNIT, "status")), list(c.UNIT), "left")
            .withColumn(c.TOTAL_ONLY, total_only_condition(total, statuses))
            .drop("status"))


def flag_total_zero(responses: DataFrame, contributors: DataFrame,
                    total: int = c.TOTAL_QUESTION,
                    statuses: Iterable[str] = c.CLEAR_STATUSES) -> DataFrame:
    return (responses.join(by_merge(contributors.select(*c.UNIT, "status")), list(c.UNIT), "left")
            .withColumn(c.TOTAL_ZERO, total_zero_condition(total, statuses))
            .drop("status"))


def enforce_types(df: DataFrame, keep: Iterable[str], types: Mapping[str, str]) -> DataFrame:
    """Prune to ``keep`` and cast; text that is no number becomes missing, infinity raises.

    ``types`` maps a column to int, float, str or date; a date is kept as integer yyyymm.
    """
    spark_types = {"int": "bigint", "float": "double", "str": "string", "date": "int"}
    kinds = dict(df.dtypes)
    out = []
    for name in keep:
        kind = types.get(name)
        column = F.col(name)
        if kind == "date" and kinds[name] in ("date", "timestamp"):
            column = F.date_format(column, "yyyyMM")
        if kind is not None:
            column = column.try_cast(spark_types[kind])
        if kind == "float":
            column = F.when(F.abs(column) == float("inf"), F.raise_error(
                F.lit(f"infinity in column {name}")).cast("double")).when(
                ~F.isnan(column), column)
        out.append(column.alias(name))
    return df.select(*out)
