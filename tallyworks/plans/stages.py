"""From returns to the results table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallyworks import constants as c
from tallyworks.functions.expressions import is_in, not_equal, pounds_thousands
from tallyworks.functions.joins import by_merge
from tallyworks.operators import estimation, imputation, outliers, outputs, panel, reconcile
from tallyworks.operators import staging
from tallyworks.settings import SurveySettings

Keep = Callable[..., DataFrame]


@dataclass(frozen=True)
class SurveyInputs:
    """Tables a run reads.  ``responses`` and ``contributors`` include back data."""

    responses: DataFrame
    contributors: DataFrame
    frame: DataFrame
    population: DataFrame
    sample: DataFrame
    classifications: DataFrame
    l_values: DataFrame
    manual: DataFrame | None = None
    manual_weights: DataFrame | None = None
    link_filter: DataFrame | None = None


@dataclass(frozen=True)
class Staged:
    panel: DataFrame
    unprocessed: DataFrame


def by_reference(df: DataFrame) -> DataFrame:
    """The one shuffle of a run: later windows, joins and stage tables keep to it."""
    return df.repartition(c.REFERENCE)


def stage_panel(responses: DataFrame, contributors: DataFrame, frame: DataFrame,
                settings: SurveySettings, manual: DataFrame | None = None,
                keep: Keep | None = None) -> Staged:
    """Expected questions of every unit with status, frame columns, flags and class.

    Status is attached once and decides exclusion, freezing and both total flags, in place
    of one join for each of them.  With ``keep`` the units and the answers with their status
    are stored by reference: the spine, the live values and the unprocessed questions then
    read them without a shuffle and without joining again.
    """
    units = staging.panel_full_outer(by_reference(contributors), by_reference(frame))
    if keep is not None:
        units = keep(by_reference(units), "units", by=c.REFERENCE)
    rows = by_reference(responses).join(
        by_merge(units.select(*c.UNIT, "status", "statusencoded")), list(c.UNIT), "left")
    if keep is not None:
        rows = keep(rows, "answers", by=c.REFERENCE)
    in_window = not_equal(c.PERIOD, settings.backdata_period)
    rows = rows.where(~(in_window & is_in("status", settings.non_response_statuses)))
    answers, aside = staging.split_questions(rows, settings.unprocessed)

    in_error = in_window & is_in("statusencoded", settings.error_codes)
    if settings.state == "live":
        in_error = F.lit(False)
    live = answers.where(in_error).select(
        *c.CELL_KEY, F.col(c.TARGET).alias(f"live_{c.TARGET}"))
    flagged = answers.where(~in_error).withColumns({
        c.TOTAL_ONLY: staging.total_only_condition(settings.total, settings.clear_statuses),
        c.TOTAL_ZERO: staging.total_zero_condition(settings.total, settings.clear_statuses),
    }).drop("status", "statusencoded")

    full = panel.expected_questions(
        flagged, units, settings.components, manual, settings.total)
    full = panel.add_zero_questions(
        full, (*settings.clear_statuses, *settings.nil_statuses), "skipped_question",
        settings.components)
    full = full.join(by_merge(live), list(c.CELL_KEY), "left")
    full = staging.imputation_class(staging.monthly_auxiliary(full), settings.bands)
    full = staging.null_total_only_components(
        staging.nil_to_zero(full, settings.nil_statuses), settings.total)

    unprocessed = staging.attach_contributors(
        staging.drop_routing_questions(aside).drop("status", "statusencoded"), units)
    return Staged(full, unprocessed)


def impute_panel(staged: DataFrame, settings: SurveySettings,
                 manual: DataFrame | None = None, link_filter: DataFrame | None = None,
                 keep: Keep | None = None) -> DataFrame:
    """Staged panel to a complete one: imputed, reconciled, totals derived.

    Reads the panel without a shuffle if it was kept by reference.
    """
    rows = imputation.ratio_of_means(staged, settings, manual, link_filter, keep)
    rows = rows.where(~F.col("is_backdata")).drop("is_backdata")
    rows = panel.add_zero_questions(
        rows, (c.CHECK_NEEDED, *settings.non_response_statuses), "derived_zeros",
        settings.components)
    rows = staging.refill_auxiliary(imputation.mark_derived_zeros(rows))
    rows = reconcile.rescale_total_only(rows, settings.total)
    rows = reconcile.derive_total(panel.create_total(rows, settings.total), settings.total)
    return rows.withColumn(c.THOUSANDS, pounds_thousands(
        F.col(c.QUESTION), F.col(c.TARGET), settings.in_thousands))


def weighted_panel(imputed: DataFrame, inputs: SurveyInputs, settings: SurveySettings,
                   keep: Keep | None = None) -> DataFrame:
    return estimation.estimate(imputed, inputs.population, inputs.sample, settings, keep)


def trimmed_panel(weighted: DataFrame, inputs: SurveyInputs, settings: SurveySettings,
                  keep: Keep | None = None) -> DataFrame:
    return outliers.detect_outlier(
        weighted, inputs.classifications, inputs.l_values, inputs.manual_weights,
        settings.components, settings.total, keep)


@dataclass(frozen=True)
class SurveyTables:
    """What a run leaves behind: the results and the tables its reports come from."""

    results: DataFrame
    staged: DataFrame
    weighted: DataFrame
    trimmed: DataFrame


def survey_tables(inputs: SurveyInputs, settings: SurveySettings, keep: Keep) -> SurveyTables:
    """From returns to the results table.

    Stages that are read more than once are written first: the panel feeds links and
    chains, the weighted panel feeds stratum sums and outlier weights.  Both are kept by
    reference, which spares every later stage the shuffle of the whole panel.
    """
    staged = stage_panel(inputs.responses, inputs.contributors, inputs.frame, settings,
                         inputs.manual, keep)
    full = keep(staged.panel, "staged", by=c.REFERENCE)
    imputed = impute_panel(full, settings, inputs.manual, inputs.link_filter, keep)
    weighted = keep(weighted_panel(imputed, inputs, settings, keep), "weighted",
                    by=c.REFERENCE)
    trimmed = trimmed_panel(weighted, inputs, settings, keep)
    filtered = inputs.link_filter is not None
    named = imputation.filtered_link_counts(trimmed) if filtered else trimmed
    results = outputs.results_table(named, staged.unprocessed, filtered)
    return SurveyTables(results, full, weighted, trimmed)


def survey_results(inputs: SurveyInputs, settings: SurveySettings, keep: Keep) -> DataFrame:
    return survey_tables(inputs, settings, keep).results
