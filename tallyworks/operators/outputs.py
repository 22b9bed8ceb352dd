"""Published tables and quality-assurance extracts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyworks import constants as c
from tallyworks.functions.expressions import (
    amount_parts, exact_sum, exact_variance, grossed, int_array, is_in, joined_parts,
    month_label, not_equal, quarter_label, quarter_periods, rounded, size_band, truthy,
)
from tallyworks.settings import SurveySettings

IMPUTED_MARKERS = ("fir", "bir", "mc", "fimc", "fic", "c")

QA_IDS = (c.PERIOD, c.SIC, c.REFERENCE, c.CELL, c.AUXILIARY, "froempment", "runame1")


def results_columns(link_filtered: bool = False) -> list[str]:
    """Columns of the results table, in order (fixed values)."""
    side = "_filtered" if link_filtered else ""
    t = c.TARGET
    return [
        c.REFERENCE, c.PERIOD, c.SIC, "classification", c.CELL, c.AUXILIARY, "froempment",
        "formtype", c.QUESTION, "statusencoded", "design_weight", "calibration_factor",
        "outlier_weight", c.MARKER, c.CLASS, f"f_link_{t}", f"default_link_f_match_{t}",
        f"b_link_{t}", f"default_link_b_match_{t}", "construction_link",
        "flag_construction_matches_count", "default_link_flag_construction_matches", t,
        c.THOUSANDS, "response", "status", "runame1", "entname1", "region",
        "winsorised_value", c.TOTAL_ONLY, "derived_zeros",
        f"b_match{side}_{t}_count", f"f_match{side}_{t}_count",
    ]


def results_projection(df: DataFrame, link_filtered: bool = False) -> DataFrame:
    return df.select(*results_columns(link_filtered))


def results_table(weighted: DataFrame, unprocessed: DataFrame,
                  link_filtered: bool = False) -> DataFrame:
    """Weighted panel and unprocessed answers in one table."""
    panel = weighted.withColumns({
        "classification": F.col("classification").cast("string"),
        c.CELL: F.col(c.CELL).cast("int"),
    })
    return results_projection(
        panel.unionByName(unprocessed, allowMissingColumns=True), link_filtered)


def target_in_thousands(results: DataFrame,
                        unprocessed: Iterable[int] = c.UNPROCESSED_QUESTIONS) -> DataFrame:
    """The target of processed questions in thousands; pounds kept as ``*_actual``."""
    return (results.withColumn(f"{c.TARGET}_actual", F.col(c.TARGET))
            .withColumn(c.TARGET, F.when(is_in(c.QUESTION, unprocessed), F.col(c.TARGET))
                        .otherwise(F.col(c.THOUSANDS))))


def derived_to_fir(df: DataFrame) -> DataFrame:
    return df.withColumn(
        c.MARKER, F.when(truthy("derived_zeros"), "fir").otherwise(F.col(c.MARKER)))


def qa_suffix(df: DataFrame, total: int = c.TOTAL_QUESTION, suffix: str = "_c") -> DataFrame:
    """Imputation markers of components under a total-only return get a suffix."""
    any_flag = F.coalesce(
        F.max(truthy(c.TOTAL_ONLY)).over(Window.partitionBy(*c.UNIT)), F.lit(False))
    change = any_flag & not_equal(c.QUESTION, total) & ~is_in(c.MARKER, ("r", "c", "mc"))
    return df.withColumn(
        c.MARKER,
        F.when(change, F.concat(F.col(c.MARKER), F.lit(suffix))).otherwise(F.col(c.MARKER)))


def qa_pivot(df: DataFrame, questions: Sequence[int]) -> DataFrame:
    """One row per unit and month: four measures per question, weights and status.

    The question list is given, so the pivot needs no job of its own.  Rows that lack an
    identifying column are left out.
    """
    extra = ("design_weight", "calibration_factor", "status")
    present = df.dropna(subset=list(QA_IDS))
    cells = []
    for question in questions:
        here = F.col(c.QUESTION) == question
        cells += [
            F.max(F.when(here, F.col(c.THOUSANDS))).alias(f"{question}__{c.TARGET}"),
            F.max(F.when(here, F.col(c.MARKER))).alias(f"{question}__{c.MARKER}"),
            F.max(F.when(here, F.col("outlier_weight"))).alias(f"{question}__outlier_weight"),
            F.max(F.when(here, grossed(F.col(c.THOUSANDS))))
            .alias(f"{question}__weighted_adjusted_value"),
        ]
    return present.groupBy(*QA_IDS).agg(*cells, *[F.max(name).alias(name) for name in extra])


def qa_output(results: DataFrame, settings: SurveySettings) -> DataFrame:
    """QA extract of every month; its sink fans out by period."""
    rows = derived_to_fir(qa_suffix(results, settings.total))
    rows = rows.where(~is_in(c.QUESTION, (*settings.unprocessed, settings.total)))
    return qa_pivot(rows, settings.components)


def constructed(results: DataFrame, settings: SurveySettings) -> DataFrame | None:
    """Current month's values that were not returned; frozen runs only.

    Unprocessed questions have no marker and so are part of it.
    """
    if settings.state != "frozen":
        return None
    rows = results.where(F.col(c.PERIOD) == settings.current_period)
    return derived_to_fir(rows).where(not_equal(c.MARKER, "r")).select(
        c.REFERENCE, c.QUESTION, F.col(c.TARGET).alias("constructedresponse"),
        F.col(c.MARKER).alias("imputationmarker"))


def imputation_contribution(results: DataFrame, components: Sequence[int] = c.COMPONENTS,
                            periods: Iterable[int] = (),
                            total: int = c.TOTAL_QUESTION) -> DataFrame:
    """Grossed returned and imputed millions per question with a total row, in print order."""
    rows = results.where(is_in(c.QUESTION, components))
    periods = list(periods)
    if periods:
        rows = rows.where(is_in(c.PERIOD, periods))
    marker, value = F.col(c.MARKER), grossed(F.col(c.TARGET) / 1000)
    parts = {f"{name}_{part}": amount for name, condition in (
        ("returned", marker == "r"), ("imputed", marker.isin(*IMPUTED_MARKERS)))
        for part, amount in zip(("wholes", "parts"), amount_parts(F.when(condition, value)))}
    # Summed per question first: the roll-up then doubles a few rows, not the panel.
    sums = rows.groupBy(c.QUESTION).agg(*[F.sum(a).alias(n) for n, a in parts.items()])
    sums = sums.rollup(c.QUESTION).agg(
        *[joined_parts(F.sum(f"{name}_wholes"), F.sum(f"{name}_parts")).alias(name)
          for name in ("returned", "imputed")], F.grouping(c.QUESTION).alias("_total"))
    order = F.array_position(
        int_array([*c.CONTRIBUTION_ORDER,
                   *[q for q in components if q not in c.CONTRIBUTION_ORDER]]),
        F.col(c.QUESTION))
    return (sums.withColumn(
                c.QUESTION,
                F.when(F.col("_total") == 1, F.lit(total)).otherwise(F.col(c.QUESTION)))
            .fillna(0.0, ["returned", "imputed"])
            .withColumn("total", F.col("returned") + F.col("imputed"))
            .orderBy(order)
            .select(c.QUESTION, "returned", "total", "imputed"))


def _complete(cells: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Every combination of the values present in ``cells``, an aggregated table, with the
    other columns of ``cells`` where the combination is there.

    One aggregate gathers the values of each dimension and the cells themselves, as a map, and
    both are expanded from it, so that the cells are computed once and nothing is joined.  Its
    row holds a published table: at most the product of short code lists (classification,
    question, size band, quarter), whatever the number of answers behind it.
    """
    values = [name for name in cells.columns if name not in dimensions]
    key = F.struct(*[F.col(name) for name in dimensions])
    present = F.forall(F.array(*[F.col(name).isNotNull() for name in dimensions]), lambda x: x)
    gathered = cells.agg(
        F.map_from_entries(F.collect_list(F.when(present, F.struct(
            key.alias("key"), F.struct(*values).alias("value"))))).alias("_cells"),
        *[F.sort_array(F.collect_set(name)).alias(name) for name in dimensions])
    for name in dimensions:
        gathered = gathered.withColumn(name, F.explode(name))
    return (gathered.withColumn("_cell", F.try_element_at("_cells", key))
            .select(*dimensions, *[F.col("_cell")[name].alias(name) for name in values]))


def growth_table(results: DataFrame, periods: Sequence[int]) -> DataFrame:
    """Grossed target per classification, question and size band, one column per month.

    One sum per cell and month in one pass over the results; columns are made of that small
    table.  A month of the results that ``periods`` does not list raises.
    """
    keys = ["classification", c.QUESTION, "sizeband"]
    months = [month_label(period) for period in periods]
    sums = (results.where(F.col("classification").isNotNull() & F.col(c.CELL).isNotNull())
            .withColumn("classification", F.col("classification").cast("int"))
            .withColumn("sizeband", size_band(F.col(c.CELL)))
            .groupBy(*keys, c.PERIOD).agg(exact_sum(grossed(F.col(c.TARGET))).alias("_sum")))
    listed = F.when(is_in(c.PERIOD, periods), F.col("_sum")).otherwise(F.raise_error(
        F.concat(F.lit("month without a column: "), F.coalesce(
            F.col(c.PERIOD).cast("string"), F.lit("none")))).cast("double"))
    cells = sums.groupBy(*keys).agg(F.map_from_entries(F.collect_list(
        F.struct(F.col(c.PERIOD), listed))).alias("_months"))
    return _complete(cells, keys).select(*keys, *[
        F.coalesce(F.try_element_at("_months", F.lit(period)), F.lit(0.0)).alias(label)
        for period, label in zip(periods, months)])


def cord(results: DataFrame, periods: Sequence[int], settings: SurveySettings) -> DataFrame:
    """Growth table of the components with lettered size bands; bands nobody is in are
    added with zeros for every published classification and component."""
    growth = growth_table(results.where(is_in(c.QUESTION, settings.components)), periods)
    letters = list(c.SIZE_BAND_LETTERS.values())
    lettered = growth.withColumn(
        "sizeband", F.element_at(F.array(*[F.lit(x) for x in letters]), F.col("sizeband")))
    absent = (
        lettered.agg(F.collect_set("sizeband").alias("_bands"))
        .select(F.explode(F.array_except(
            F.array(*[F.lit(x) for x in letters]), F.col("_bands"))).alias("sizeband"))
        .withColumn("classification", F.explode(int_array(settings.classifications)))
        .withColumn(c.QUESTION, F.explode(int_array(settings.components))))
    return (lettered.unionByName(absent, allowMissingColumns=True).fillna(0.0)
            .orderBy("classification", "sizeband", c.QUESTION))


_QUARTER = re.compile(r"\d{4}Q[1-4]")


def sizeband(results: DataFrame, components: Sequence[int] = c.COMPONENTS,
             quarters: Iterable[str] = ()) -> DataFrame:
    """Grossed target per quarter and size band, one column per question, zeros filled."""
    quarters = list(quarters)
    for quarter in quarters:
        if not _QUARTER.fullmatch(str(quarter)):
            raise ValueError(f"Invalid quarter format: {quarter}, expected e.g. 2023Q1")
    rows = results.where(is_in(c.QUESTION, components))
    if quarters:
        rows = rows.where(is_in(
            c.PERIOD, [period for quarter in quarters for period in quarter_periods(quarter)]))
    rows = rows.withColumns({
        "quarter": quarter_label(F.col(c.PERIOD)),
        "sizeband": size_band(F.col(c.CELL)),
    })
    value = grossed(F.col(c.TARGET))
    keys = ["quarter", "sizeband"]
    sums = rows.groupBy(*keys).agg(*[
        exact_sum(F.when(F.col(c.QUESTION) == question, value)).alias(str(question))
        for question in components])
    return _complete(sums, keys).fillna(0.0).orderBy(*keys)


def standard_errors(results: DataFrame, value: str = c.TARGET) -> DataFrame:
    """Sample variance, standard error and coefficient of variation per cell, to three places.

    Moments are exact and rounding is decimal, halves away from zero, so that neither row
    order nor partitioning decides a last digit.
    """
    keys = [c.PERIOD, c.QUESTION, "classification", c.CELL]
    moments = zip(("_variance", "_n", "_mean"), exact_variance(F.col(value)))
    sums = results.groupBy(*keys).agg(*[moment.alias(name) for name, moment in moments])
    variance = F.col("_variance")
    error = F.sqrt(F.try_divide(variance, F.col("_n")))
    spread = F.try_divide(100 * F.sqrt(variance), F.col("_mean"))
    return sums.select(
        *keys, rounded(variance, 3).alias("sample_var"),
        rounded(error, 3).alias("std_error"),
        rounded(spread, 3).alias("cov"))
