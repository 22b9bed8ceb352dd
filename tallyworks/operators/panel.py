"""The full panel: every expected question of every unit and month."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyworks import constants as c
from tallyworks.functions.expressions import int_array, is_in, truthy
from tallyworks.functions.joins import by_merge


def expected_questions(responses: DataFrame, contributors: DataFrame,
                       components: Iterable[int] = c.COMPONENTS,
                       manual: DataFrame | None = None,
                       total: int = c.TOTAL_QUESTION) -> DataFrame:
    """Every contributor with the questions it answered or should have answered.

    A unit without answers is expected to answer what it answered last, else every
    component; months before count in row order.  Manual constructions add their
    questions from their month on.  A total-only return is expected to hold every
    component and the total, a zero total-only return the total alone.  Other columns of
    ``contributors`` are carried along.

    Answers travel as one short array per (reference, period), at most the questions of
    one form, so they are shuffled once.
    """
    components = list(components)
    unit = list(c.UNIT)
    payload = [name for name in responses.columns if name not in unit]
    is_total = F.col(c.QUESTION) == total
    pairs = responses.groupBy(*unit).agg(
        F.collect_list(F.struct(*payload)).alias("_answers"),
        F.max(F.when(is_total, F.col(c.TOTAL_ONLY))).alias("_total_only"),
        F.max(F.when(is_total, F.col(c.TOTAL_ZERO))).alias("_total_zero"),
    )
    spine = contributors.join(by_merge(pairs), unit, "left")

    only, zero = truthy("_total_only"), truthy("_total_zero")
    answered = F.array_distinct(F.transform("_answers", lambda a: a[c.QUESTION]))
    listed = F.when(only | zero, int_array([*components, total])).otherwise(answered)
    so_far = (Window.partitionBy(c.REFERENCE).orderBy(c.PERIOD)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spine = spine.withColumn("_listed", listed).withColumn(
        "_helper", F.array_intersect("_listed", int_array(components)))
    if manual is not None:
        by_hand = manual.groupBy(*unit).agg(F.collect_set(c.QUESTION).alias("_by_hand"))
        spine = spine.join(by_merge(by_hand), unit, "left")
    carried = {"_helper": F.coalesce(
        F.last("_helper", ignorenulls=True).over(so_far), int_array(components))}
    if manual is not None:
        carried["_by_hand"] = F.coalesce(
            F.last("_by_hand", ignorenulls=True).over(so_far), int_array([]))
    spine = spine.withColumns(carried)
    helper = F.col("_helper")
    if manual is not None:
        helper = F.array_union(helper, F.col("_by_hand"))
    expected = F.when(zero, int_array([total])).otherwise(
        F.coalesce(F.col("_listed"), helper))

    def answers_to(question: Column) -> Column:
        return F.struct(
            question.alias("question"),
            F.filter("_answers", lambda a: (a[c.QUESTION] == question)
                     & (a[c.TOTAL_ONLY] == only) & (a[c.TOTAL_ZERO] == zero)).alias("hits"))

    attributes = [name for name in contributors.columns if name not in unit]
    rest = [name for name in payload if name not in (c.QUESTION, c.TOTAL_ONLY, c.TOTAL_ZERO)]
    lines = spine.select(
        *unit, *attributes, only.alias(c.TOTAL_ONLY), zero.alias(c.TOTAL_ZERO),
        F.explode(F.transform(expected, answers_to)).alias("_line"))
    return lines.select(
        *unit, F.col("_line.question").alias(c.QUESTION), c.TOTAL_ONLY, c.TOTAL_ZERO,
        *attributes, F.explode_outer("_line.hits").alias("_hit"),
    ).select(
        *unit, c.QUESTION, c.TOTAL_ONLY, c.TOTAL_ZERO, *attributes,
        *[F.col("_hit").getField(name).alias(name) for name in rest])


def with_added_rows(df: DataFrame, codes: Column, values: dict[str, Column],
                    flag: str | None = None,
                    keep: Iterable[str] = c.UNIT_ATTRIBUTES) -> DataFrame:
    """Add one row per question code in ``codes``, an array set on one row of a unit.

    New rows copy the unit's attributes, take ``values`` and leave the rest missing.
    The panel passes through once: no union, no second read of it.
    """
    kept = {*c.UNIT, *keep}
    widened = df.select("*", F.explode(
        F.concat(F.array(F.lit(None).cast("int")), codes)).alias("_added"))
    created = F.col("_added").isNotNull()
    kinds = dict(df.dtypes)
    out = []
    for name in df.columns:
        column = F.col(name)
        if name == c.QUESTION:
            column = F.coalesce(F.col("_added"), column)
        elif name in values:
            column = F.when(created, values[name].cast(kinds[name])).otherwise(column)
        elif name not in kept:
            column = F.when(~created, column)
        out.append(column.alias(name))
    if flag is not None:
        out = [column for column, name in zip(out, df.columns) if name != flag]
        out.append(created.alias(flag))
    return widened.select(*out)


def add_zero_questions(df: DataFrame, statuses: Iterable[str], flag: str,
                       components: Iterable[int] = c.COMPONENTS) -> DataFrame:
    """Components absent from units in one of ``statuses`` are added with value zero.

    ``flag`` is true on added rows.  Used for skipped questions of clear units and for
    derived zeros of units that did not answer.
    """
    by_question = Window.partitionBy(*c.UNIT).orderBy(c.QUESTION)
    whole = by_question.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = df.withColumns({
        "_present": F.collect_set(c.QUESTION).over(whole),
        "_line": F.row_number().over(by_question),
    })
    codes = F.when(
        (F.col("_line") == 1) & is_in("status", statuses),
        F.array_except(int_array(components), F.col("_present")),
    ).otherwise(int_array([]))
    out = with_added_rows(
        marked, codes, {c.TARGET: F.lit(0.0), c.TOTAL_ONLY: F.lit(False)}, flag)
    return out.withColumn(c.TOTAL_ONLY, truthy(c.TOTAL_ONLY)).drop("_present", "_line")


def create_total(df: DataFrame, total: int = c.TOTAL_QUESTION) -> DataFrame:
    """Units without a total row get one: value 0 and the transient marker d_create."""
    by_question = Window.partitionBy(*c.UNIT).orderBy(c.QUESTION)
    whole = by_question.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = df.withColumns({
        "_has_total": F.max(F.col(c.QUESTION) == total).over(whole),
        "_line": F.row_number().over(by_question),
    })
    codes = F.when((F.col("_line") == 1) & ~F.col("_has_total"), int_array([total])).otherwise(
        int_array([]))
    values = {c.TARGET: F.lit(0.0), c.MARKER: F.lit("d_create"), c.TOTAL_ONLY: F.lit(False)}
    return with_added_rows(marked, codes, values).drop("_has_total", "_line")
