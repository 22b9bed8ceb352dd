"""Conversion of legacy question and contributor files to panel form."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window, functions as F

from tallyworks import constants as c
from tallyworks.functions.expressions import is_in
from tallyworks.functions.joins import by_merge

LEGACY_UNIT = ("reference", "period")
NO_ANSWER = ("derived", "selected, no return")


def _says_no(answer, no_values: Iterable):
    """Membership in a list that may mix numbers, words and a missing value."""
    no_values = list(no_values)
    words = [str(v).lower() for v in no_values if isinstance(v, str)]
    numbers = [float(v) for v in no_values if v is not None and not isinstance(v, str)]
    text = answer.cast("string")
    hit = is_in(F.lower(text), words) | is_in(text.try_cast("double"), numbers)
    if None in no_values:
        hit = hit | answer.isNull()
    return hit


def routing(responses: DataFrame, no_values: Iterable,
            routes: Mapping[int, Iterable[int]] = c.ROUTES,
            question: str = c.QUESTION, value: str = c.TARGET) -> DataFrame:
    """Drop questions of a route answered "no" whose answers are all zero or missing.

    One window per (reference, period) serves all routes: at most one form per group.
    """
    unit = Window.partitionBy(*LEGACY_UNIT)
    q = F.col(question)
    number = F.col(value).cast("string").try_cast("double")
    skipped = F.lit(False)
    helpers = {}
    for route, routed in routes.items():
        helpers[f"_sum_{route}"] = F.coalesce(
            F.sum(F.when(is_in(q, routed), number)).over(unit), F.lit(0.0))
        helpers[f"_answer_{route}"] = F.max(F.when(q == route, F.col(value))).over(unit)
        skipped = skipped | (
            is_in(q, routed) & (F.col(f"_sum_{route}") == 0)
            & _says_no(F.col(f"_answer_{route}"), no_values))
    return responses.withColumns(helpers).where(~skipped).drop(*helpers)


def repeated_routes(responses: DataFrame, routes: Iterable[int] = tuple(c.ROUTES),
                    question: str = c.QUESTION) -> DataFrame:
    """Route questions a unit answers more than once, with how often."""
    return (responses.where(is_in(question, routes)).groupBy(*LEGACY_UNIT, question)
            .agg(F.count(F.lit(1)).alias("n_answers")).where("n_answers > 1"))


def drop_nil(responses: DataFrame, contributors: DataFrame,
             response_types: Iterable[int] = c.NIL_RESPONSE_TYPES) -> DataFrame:
    nil = contributors.where(is_in("response_type", response_types))
    return responses.join(by_merge(nil), list(LEGACY_UNIT), "left_anti")


def legacy_responses(questions: DataFrame) -> DataFrame:
    """Legacy question rows in panel columns; their type becomes a marker if present."""
    out = questions.withColumnsRenamed({
        "question_no": c.QUESTION, "returned_value": "response", "adjusted_value": c.TARGET})
    if "type" not in out.columns:
        return out
    kind = F.lit(None).cast("string")
    for code, marker in c.BACK_DATA_MARKERS.items():
        kind = F.when(F.col("type") == code, marker).otherwise(kind)
    return out.withColumn(c.MARKER, kind).drop("type")


def legacy_contributors(contributors: DataFrame) -> DataFrame:
    """Legacy contributor rows with the status their error marker stands for.

    E and W need checking, O was overridden, anything else is clear.
    """
    marker = F.upper(F.trim("error_mkr"))
    status = (F.when(marker.isin("E", "W"), c.CHECK_NEEDED)
              .when(marker == "O", "Clear - overridden").otherwise("Clear"))
    code = F.when(marker.isin("E", "W"), 201).when(marker == "O", 211).otherwise(210)
    return contributors.withColumns({"status": status, "statusencoded": code})


def append_back_data(responses: DataFrame, contributors: DataFrame,
                     back_questions: DataFrame, back_contributors: DataFrame,
                     ) -> tuple[DataFrame, DataFrame]:
    """The month before the revision window, added to both tables.

    Derived values and units without a return are no answers and are left out.  Contributors
    that repeat are kept once, wherever they come from.
    """
    answered = ~is_in(c.MARKER, NO_ANSWER)
    answers = legacy_responses(back_questions).where(answered).select(
        c.REFERENCE, c.PERIOD, c.QUESTION, F.col("response").cast("string").alias("response"),
        F.col(c.TARGET).cast("double").alias(c.TARGET), c.MARKER)
    units = legacy_contributors(back_contributors).select(*c.UNIT, "status", "statusencoded")
    return (responses.unionByName(answers, allowMissingColumns=True),
            contributors.unionByName(units, allowMissingColumns=True).distinct())


def join_sample(contributors: DataFrame, frame: DataFrame) -> DataFrame:
    """Contributors with the sample-frame columns under their snapshot names."""
    columns = frame.select(
        *c.UNIT,
        F.col(c.CELL).alias("cellnumber"),
        F.concat(F.lit("0"), F.col("formtype").cast("string")).alias("formtype"),
        F.col("froempees").alias("frozenemployees"),
        F.col(c.SIC).alias("frozensic"),
        F.col(c.AUXILIARY).alias("frozenturnover"))
    return contributors.join(by_merge(columns), list(c.UNIT), "left")
