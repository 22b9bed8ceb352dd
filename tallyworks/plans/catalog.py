"""Named queries over the order tables, one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyworks import constants as c
from tallyworks.functions.expressions import (
    annual_to_monthly, grossed, pounds_thousands,
)
from tallyworks.functions.joins import by_merge
from tallyworks.operators import (
    estimation, gates, imputation, legacy, outliers, outputs, panel, reconcile, regions, staging,
)
from tallyworks.plans import additional, conversion, stages
from tallyworks.plans.saved import saved_run
from tallyworks.plans.session import tune
from tallyworks.settings import SurveySettings
from tallyworks.sources import frames, order_survey as survey, sinks, snapshot
from tallyworks.sources.store import RunStore

S = survey.SETTINGS
KEY = c.CELL_KEY
PRINTED_QUARTER = "2001Q3"
NO_VALUES = (2, None)
Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf_dir: function(tune(spark), sf_dir)
    return function


# ---- sources and sinks ---------------------------------------------------------------
def _both_parts(contributors: DataFrame, responses: DataFrame) -> DataFrame:
    return contributors.unionByName(responses, allowMissingColumns=True)


@query
def src_snapshot_records(spark, sf):
    path = RunStore(spark, "snapshot").path("records")
    snapshot.write_snapshot(survey.contributors(spark, sf),
                            survey.answers(spark, sf).drop(c.MARKER), path, "records",
                            columnar=False)
    return _both_parts(*snapshot.read_snapshot_records(spark, path, lines=True))


@query
def src_snapshot_columnar(spark, sf):
    path = RunStore(spark, "snapshot").path("columns")
    snapshot.write_snapshot(survey.contributors(spark, sf),
                            survey.answers(spark, sf).drop(c.MARKER), path, "columns")
    return _both_parts(*snapshot.read_snapshot_columnar(spark, path, lines=True))


@query
def src_csv(spark, sf):
    path = RunStore(spark, "csv").path("manual")
    manual = survey.manual(spark, sf)
    sinks.write_csv(manual, path)
    return frames.read_csv(spark, path, manual.columns)


def _frame_folder(spark, sf) -> str:
    path = RunStore(spark, "frames").path("sample")
    sinks.write_colon_by_month(survey.frame(spark, sf), frames.SAMPLE_COLUMNS, path, "sample_")
    return path


FRAME_COLUMNS = (*c.UNIT, c.SIC, "formtype", c.CELL, "froempment", c.AUXILIARY, "region",
                 "runame1", "entname1")


@query
def src_colon(spark, sf):
    return frames.read_colon(spark, f"{_frame_folder(spark, sf)}/frame=sample_*",
                             frames.SAMPLE_COLUMNS, FRAME_COLUMNS)


@query
def src_frame_window(spark, sf):
    return frames.read_frame_window(spark, _frame_folder(spark, sf), "frame=sample_",
                                    frames.SAMPLE_COLUMNS, S.current_period, 14, FRAME_COLUMNS)


@query
def src_local_units(spark, sf):
    path = RunStore(spark, "frames").path("units")
    units = survey.local_units(spark, sf).withColumnRenamed(c.REFERENCE, "ruref")
    sinks.write_colon_by_month(units, frames.LOCAL_UNIT_COLUMNS, path, "units_")
    return frames.read_local_units(spark, path, "frame=units_", S.current_period, 6)


@query
def enforce_types(spark, sf):
    text = survey.responses(spark, sf)
    text = text.select(*[F.col(name).cast("string").alias(name) for name in text.columns])
    return staging.enforce_types(text, [*KEY, c.TARGET], frames.FRAME_TYPES)


@query
def append_back_data(spark, sf):
    back = F.col(c.PERIOD) == S.backdata_period
    answers = survey.answers(spark, sf).where(~back).drop(c.MARKER)
    units = survey.contributors(spark, sf).where(~back)
    questions = survey.legacy_questions(spark, sf).where(back)
    rows, contributors = legacy.append_back_data(
        answers, units, questions, survey.legacy_units(spark, sf).where(back))
    return _both_parts(contributors, rows.select(*KEY, c.TARGET, c.MARKER))


@query
def legacy_to_panel(spark, sf):
    return legacy.legacy_contributors(survey.legacy_units(spark, sf)).select(
        *c.UNIT, "status", "statusencoded", "response_type")


def _legacy_frame(spark, sf) -> DataFrame:
    return survey.frame(spark, sf).withColumnRenamed("froempment", "froempees")


@query
def join_sample(spark, sf):
    return legacy.join_sample(survey.contributors(spark, sf), _legacy_frame(spark, sf))


@query
def legacy_snapshot(spark, sf):
    path = RunStore(spark, "legacy").path("snapshot")
    conversion.legacy_snapshot(
        survey.legacy_questions(spark, sf), survey.legacy_units(spark, sf),
        _legacy_frame(spark, sf), NO_VALUES, path, "legacy")
    units, rows = snapshot.read_snapshot_columnar(
        spark, path, lines=True, contributor_fields=(
            *snapshot.CONTRIBUTOR_FIELDS, "cellnumber", "formtype", "frozenemployees",
            "frozensic", "frozenturnover"))
    return _both_parts(units, rows.withColumn("response", F.col("response").cast("double")))


@query
def sink_csv(spark, sf):
    path = RunStore(spark, "out").path("sizeband")
    table = outputs.sizeband(_thousands(spark, sf), S.components)
    sinks.write_csv(table, path, header=False)
    return spark.read.schema(table.schema).csv(path)


@query
def sink_by_period(spark, sf):
    path = RunStore(spark, "out").path("qa")
    table = outputs.qa_output(saved_run(spark, sf).results, S)
    sinks.write_by_period(table, path)
    return spark.read.schema(table.schema).csv(path).drop("_period")


@query
def sink_stage(spark, sf):
    store = RunStore(spark, "stages")
    return store.keep(survey.answers(spark, sf), "answers")


@query
def src_results(spark, sf):
    """The outputs job reads what the main job saved."""
    return saved_run(spark, sf).results.select(*KEY, c.MARKER, c.TARGET)


# ---- row rules -----------------------------------------------------------------------
def _thousands(spark, sf) -> DataFrame:
    return outputs.target_in_thousands(saved_run(spark, sf).results)


@query
def split_questions(spark, sf):
    rows = legacy.legacy_responses(survey.legacy_questions(spark, sf))
    kept, aside = staging.split_questions(rows, c.UNPROCESSED_QUESTIONS)
    return (kept.withColumn("processed", F.lit(True))
            .union(aside.withColumn("processed", F.lit(False)))
            .select(*KEY, c.TARGET, "processed"))


@query
def results_projection(spark, sf):
    run = saved_run(spark, sf)
    weights = run.trimmed.withColumn(
        "classification", F.col("classification").cast("string"))
    return outputs.results_projection(weights)


@query
def masked_replace(spark, sf):
    rows = survey.responses(spark, sf)
    return staging.masked_replace(rows, c.TARGET, F.col(c.TARGET) < 10_000)


@query
def null_total_only_components(spark, sf):
    rows = staging.flag_total_only(
        survey.mixed_answers(spark, sf), survey.contributors(spark, sf))
    return staging.null_total_only_components(
        rows.withColumn("skipped_question", F.lit(False)))


@query
def nil_to_zero(spark, sf):
    rows = staging.attach_contributors(
        survey.responses(spark, sf), survey.contributors(spark, sf))
    return staging.nil_to_zero(rows).select(*KEY, "status", c.TARGET)


@query
def annual_to_monthly_auxiliary(spark, sf):
    return survey.frame(spark, sf).select(
        *c.UNIT, annual_to_monthly(F.col(c.AUXILIARY)).alias(c.MONTHLY_AUXILIARY))


QUERIES["annual_to_monthly"] = QUERIES.pop("annual_to_monthly_auxiliary")


@query
def pounds_thousands_column(spark, sf):
    return survey.responses(spark, sf).withColumn(c.THOUSANDS, pounds_thousands(
        F.col(c.QUESTION), F.col(c.TARGET), (*c.COMPONENTS, S.total)))


QUERIES["pounds_thousands"] = QUERIES.pop("pounds_thousands_column")


def _zeroed(spark, sf) -> DataFrame:
    """Ratio-of-means result of the published months with derived zeros added."""
    rows = saved_run(spark, sf).chained.where(~F.col("is_backdata"))
    return panel.add_zero_questions(
        rows, (c.CHECK_NEEDED, *S.non_response_statuses), "derived_zeros", S.components)


@query
def derived_zeros(spark, sf):
    return _zeroed(spark, sf).select(
        *KEY, "status", c.CELL, "derived_zeros", "skipped_question", "290_flag",
        c.TARGET)


@query
def mark_derived_zeros(spark, sf):
    return imputation.mark_derived_zeros(_zeroed(spark, sf)).select(
        *KEY, c.MARKER, "derived_zeros")


@query
def refill_auxiliary(spark, sf):
    return staging.refill_auxiliary(_zeroed(spark, sf)).select(*KEY, c.MONTHLY_AUXILIARY)


@query
def derived_to_fir(spark, sf):
    return outputs.derived_to_fir(saved_run(spark, sf).results).select(*KEY, c.MARKER)


@query
def target_in_thousands(spark, sf):
    return _thousands(spark, sf).select(*KEY, c.TARGET, f"{c.TARGET}_actual")


@query
def grossed_value(spark, sf):
    return saved_run(spark, sf).results.select(
        *KEY, grossed(F.col(c.THOUSANDS)).alias("grossed"))


@query
def check_nonresponse_in_responses(spark, sf):
    return staging.check_nonresponse_in_responses(
        survey.responses(spark, sf), survey.contributors(spark, sf))


# ---- joins and panel -----------------------------------------------------------------
@query
def panel_full_outer(spark, sf):
    """Units that returned lines against the frame of the published months."""
    returned = survey.raw(spark, sf).groupBy(*c.UNIT).agg(
        F.count("*").alias("n_questions"), F.lit("returned").alias("region"))
    published = survey.frame(spark, sf).where(F.col(c.PERIOD) != S.backdata_period).select(
        *c.UNIT, c.CELL, "region")
    return staging.panel_full_outer(returned, published)


@query
def attach_contributors(spark, sf):
    return staging.attach_contributors(
        survey.responses(spark, sf), survey.contributors(spark, sf))


@query
def frozen_split(spark, sf):
    kept, errors = staging.frozen_split(
        survey.responses(spark, sf), survey.contributors(spark, sf), S)
    return kept.unionByName(errors, allowMissingColumns=True)


@query
def live_passthrough(spark, sf):
    live = SurveySettings(S.current_period, S.revision_window, state="live")
    kept, errors = staging.frozen_split(
        survey.responses(spark, sf), survey.contributors(spark, sf), live)
    return kept.unionByName(errors, allowMissingColumns=True)


@query
def exclude_nonresponse(spark, sf):
    return staging.exclude_nonresponse(
        survey.responses(spark, sf), survey.contributors(spark, sf))


@query
def excluded_report(spark, sf):
    return staging.excluded_report(
        survey.responses(spark, sf), survey.contributors(spark, sf))


@query
def join_l_values(spark, sf):
    return outliers.join_l_values(
        saved_run(spark, sf).weighted, survey.classifications(spark, sf),
        survey.l_values(spark, sf)).select(*KEY, c.SIC, "classification", "l_value")


@query
def imputation_class(spark, sf):
    return staging.imputation_class(survey.frame(spark, sf), S.bands).select(
        *c.UNIT, c.CELL, c.CLASS)


@query
def flag_total_only(spark, sf):
    return staging.flag_total_only(
        survey.mixed_answers(spark, sf), survey.contributors(spark, sf))


@query
def flag_total_zero(spark, sf):
    return staging.flag_total_zero(
        survey.mixed_answers(spark, sf), survey.contributors(spark, sf))


def _flagged(spark, sf) -> DataFrame:
    units = survey.contributors(spark, sf)
    rows = staging.exclude_nonresponse(survey.responses(spark, sf), units)
    return staging.flag_total_zero(staging.flag_total_only(rows, units), units)


@query
def expected_questions(spark, sf):
    return panel.expected_questions(
        _flagged(spark, sf), survey.contributors(spark, sf), S.components,
        survey.manual(spark, sf)).drop("status", "statusencoded")


@query
def skipped_questions(spark, sf):
    rows = panel.expected_questions(
        _flagged(spark, sf), survey.contributors(spark, sf), S.components)
    return panel.add_zero_questions(
        rows, (*c.CLEAR_STATUSES, *c.NIL_STATUSES), "skipped_question", S.components)


@query
def stage_panel(spark, sf):
    i = survey.inputs(spark, sf)
    return stages.stage_panel(
        i.responses, i.contributors, i.frame, S, i.manual, RunStore(spark).keep).panel.select(
        *KEY, "290_flag", "is_total_only_and_zero", "status", c.CELL, c.TARGET, c.MARKER,
        "response", "skipped_question", f"live_{c.TARGET}", c.MONTHLY_AUXILIARY, c.CLASS,
        "q290_component_set_null")


# ---- imputation ----------------------------------------------------------------------
@query
def match_flags(spark, sf):
    return imputation.match_flags(saved_run(spark, sf).staged).select(
        *KEY, imputation.F_MATCH, imputation.B_MATCH, imputation.C_MATCH)


@query
def match_counts(spark, sf):
    return imputation.link_table(saved_run(spark, sf).staged).select(
        *imputation.LINK_KEY, f"{imputation.F_MATCH}_count", f"{imputation.B_MATCH}_count",
        f"{imputation.C_MATCH}_count")


@query
def links(spark, sf):
    return imputation.link_table(saved_run(spark, sf).staged).select(
        *imputation.LINK_KEY, imputation.F_LINK, imputation.B_LINK,
        imputation.F_DEFAULT, imputation.B_DEFAULT)


@query
def links_filtered(spark, sf):
    return imputation.filtered_link_counts(imputation.link_table(
        saved_run(spark, sf).staged, survey.link_filter(spark, sf)))


@query
def construction_link(spark, sf):
    return imputation.link_table(saved_run(spark, sf).staged).select(
        *imputation.LINK_KEY, imputation.C_LINK,
        imputation.C_DEFAULT)


@query
def mark_backdata(spark, sf):
    return imputation.mark_backdata(survey.answers(spark, sf), S).select(
        *KEY, "is_backdata", c.MARKER)


def _linked(spark, sf) -> DataFrame:
    run = saved_run(spark, sf)
    rows = imputation.manual_construction(run.staged, run.inputs.manual)
    return imputation.mark_backdata(imputation.attach_links(rows, run.links), S)


@query
def manual_construction(spark, sf):
    run = saved_run(spark, sf)
    return imputation.manual_construction(run.staged, run.inputs.manual).select(
        *KEY, c.TARGET, imputation.MANUAL)


@query
def forward_impute(spark, sf):
    return imputation.forward_impute(_linked(spark, sf)).select(
        *KEY, "forward_value", "forward_kind")


@query
def backward_impute(spark, sf):
    return imputation.backward_impute(_linked(spark, sf)).select(
        *KEY, "backward_value")


@query
def construct(spark, sf):
    return imputation.construct(_linked(spark, sf)).select(
        *KEY, "constructed_value", "constructed_kind")


@query
def ratio_of_means(spark, sf):
    run = saved_run(spark, sf)
    rows = imputation.ratio_of_means(
        run.staged, S, run.inputs.manual, keep=RunStore(spark).keep)
    return rows.select(*KEY, c.TARGET, c.MARKER, "is_backdata")


@query
def rescale_total_only(spark, sf):
    return reconcile.rescale_total_only(_zeroed(spark, sf)).select(
        *KEY, c.TARGET, f"{c.TARGET}_pre_rescale", "failed_rescale")


@query
def create_total(spark, sf):
    return panel.create_total(imputation.mark_derived_zeros(_zeroed(spark, sf))).select(
        *KEY, "status", c.MARKER, "290_flag", c.TARGET)


@query
def derive_total(spark, sf):
    rows = panel.create_total(imputation.mark_derived_zeros(_zeroed(spark, sf)))
    return reconcile.derive_total(rows).select(*KEY, c.MARKER, c.TARGET)


@query
def check_totals(spark, sf):
    return reconcile.check_totals(saved_run(spark, sf).imputed)


@query
def check_r_before_d(spark, sf):
    return reconcile.check_r_before_d(saved_run(spark, sf).imputed)


@query
def check_r_before_d_top5(spark, sf):
    return reconcile.check_r_before_d_top5(saved_run(spark, sf).imputed)


@query
def impute_panel(spark, sf):
    run = saved_run(spark, sf)
    rows = stages.impute_panel(run.staged, S, run.inputs.manual, keep=RunStore(spark).keep)
    return rows.select(
        *KEY, c.TARGET, c.THOUSANDS, c.MARKER, "derived_zeros", "failed_rescale",
        c.MONTHLY_AUXILIARY)


# ---- estimation ----------------------------------------------------------------------
@query
def is_sampled(spark, sf):
    return estimation.is_sampled(survey.population(spark, sf), survey.sample(spark, sf))


@query
def population_counts(spark, sf):
    return estimation.population_counts(survey.population(spark, sf), survey.sample(spark, sf))


@query
def design_weight(spark, sf):
    return estimation.design_weight(population_counts(spark, sf), S).select(
        c.PERIOD, c.CELL, "design_weight")


@query
def calibration_factor(spark, sf):
    weights = estimation.cell_weights(survey.population(spark, sf), survey.sample(spark, sf), S)
    return weights.select(c.PERIOD, c.CELL, "is_census",
                          "calibration_factor")


@query
def estimate(spark, sf):
    run = saved_run(spark, sf)
    rows = stages.weighted_panel(run.imputed, run.inputs, S, RunStore(spark).keep)
    return rows.select(
        *KEY, "is_sampled", "is_census", "design_weight",
        "calibration_factor")


# ---- outliers ------------------------------------------------------------------------
def _valued(spark, sf) -> DataFrame:
    return outliers.join_l_values(
        saved_run(spark, sf).weighted, survey.classifications(spark, sf),
        survey.l_values(spark, sf))


@query
def winsorise(spark, sf):
    rows = outliers.winsorise(_valued(spark, sf), keep=RunStore(spark).keep)
    return rows.select(
        *KEY, "nw_ag_flag", "predicted_unit_value",
        "new_target_variable",
        "outlier_weight")


@query
def total_outlier_weight(spark, sf):
    rows = outliers.winsorise(_valued(spark, sf), keep=RunStore(spark).keep)
    return outliers.total_outlier_weight(rows).where(F.col(c.QUESTION) == S.total).select(
        *KEY, "outlier_weight")


@query
def manual_outlier_weight(spark, sf):
    rows = saved_run(spark, sf).weighted.select(
        *KEY, (F.col("froempment") / 100.0).alias("outlier_weight"))
    return outliers.manual_outlier_weight(rows, survey.manual_weights(spark, sf))


@query
def census_cells(spark, sf):
    """Weights trimmed where listed cells are taken whole: their values stay as they are."""
    run, keep = saved_run(spark, sf), RunStore(spark).keep
    listed = replace(S, census_cells=(23, 71, 104))
    weighted = stages.weighted_panel(run.imputed, run.inputs, listed, keep)
    rows = outliers.winsorise(outliers.join_l_values(
        weighted, run.inputs.classifications, run.inputs.l_values), keep=keep)
    return rows.where(F.col(c.QUESTION) != c.TOTAL_QUESTION).select(
        *KEY, F.coalesce("is_census", F.lit(False)).alias("is_census"), "nw_ag_flag",
        "new_target_variable", "outlier_weight")


@query
def winsorised_value(spark, sf):
    rows = outliers.winsorised_value(saved_run(spark, sf).trimmed.drop("winsorised_value"))
    return rows.select(*KEY, "winsorised_value")


@query
def detect_outlier(spark, sf):
    run = saved_run(spark, sf)
    rows = stages.trimmed_panel(run.weighted, run.inputs, S, RunStore(spark).keep)
    return rows.select(
        *KEY, "classification", "outlier_weight",
        "winsorised_value")


# ---- outputs -------------------------------------------------------------------------
@query
def results_table(spark, sf):
    return stages.survey_results(survey.inputs(spark, sf), S, RunStore(spark).keep)


@query
def results_table_filtered(spark, sf):
    """Results of a run that leaves listed units out of its links."""
    inputs = survey.inputs(spark, sf, link_filtered=True)
    return stages.survey_results(inputs, S, RunStore(spark).keep)


@query
def revised_results(spark, sf):
    """Saved results of all months after a run that revised the last two, twice."""
    months = (200110, 200111)
    path = RunStore(spark, "revised").path("results")
    results = saved_run(spark, sf).results.where(F.col(c.PERIOD) != S.backdata_period)
    sinks.revise_months(results, path, S.periods)
    doubled = results.where(F.col(c.PERIOD).isin(*months)).withColumn(
        c.TARGET, F.col(c.TARGET) * 2)
    for _ in range(2):
        sinks.revise_months(doubled, path, months)
    return sinks.read_months(spark, path, (*KEY, c.TARGET, c.MARKER))


@query
def routing(spark, sf):
    return legacy.routing(survey.legacy_questions(spark, sf), NO_VALUES,
                          question="question_no", value="adjusted_value")


@query
def drop_nil(spark, sf):
    return legacy.drop_nil(survey.legacy_questions(spark, sf), survey.legacy_units(spark, sf))


@query
def qa_suffix(spark, sf):
    return outputs.qa_suffix(saved_run(spark, sf).results).select(*KEY, c.MARKER, "290_flag")


@query
def qa_pivot(spark, sf):
    return outputs.qa_pivot(
        saved_run(spark, sf).results.where(F.col(c.QUESTION) != S.total), c.COMPONENTS)


@query
def qa_output(spark, sf):
    return outputs.qa_output(saved_run(spark, sf).results, S)


@query
def constructed(spark, sf):
    return outputs.constructed(_thousands(spark, sf), S)


@query
def imputation_contribution(spark, sf):
    return outputs.imputation_contribution(_thousands(spark, sf))


@query
def growth_table(spark, sf):
    return outputs.growth_table(_thousands(spark, sf), S.periods)


@query
def cord(spark, sf):
    return outputs.cord(_thousands(spark, sf), S.periods, S)


@query
def sizeband(spark, sf):
    return outputs.sizeband(_thousands(spark, sf))


@query
def standard_errors(spark, sf):
    return outputs.standard_errors(saved_run(spark, sf).trimmed, c.THOUSANDS)


@query
def rm_regional_employment(spark, sf):
    return regions.rm_regional_employment(survey.local_units(spark, sf))


@query
def rm_total_employment(spark, sf):
    return regions.rm_total_employment(survey.local_units(spark, sf))


@query
def rm_percent(spark, sf):
    return regions.rm_percent(survey.local_units(spark, sf))


def _shared(spark, sf) -> DataFrame:
    return regions.rm_rows(saved_run(spark, sf).results).join(
        by_merge(regions.rm_percent(survey.local_units(spark, sf))), list(c.UNIT), "left")


@query
def rm_fill_own_region(spark, sf):
    return regions.rm_fill_own_region(_shared(spark, sf))


def _turnover(spark, sf) -> DataFrame:
    return regions.rm_turnover(
        regions.rm_rows(saved_run(spark, sf).results),
        regions.rm_percent(survey.local_units(spark, sf)))


@query
def rm_turnover(spark, sf):
    rows = _turnover(spark, sf)
    return rows.select(
        *KEY, "gross_turnover_uk",
        *[name for name in rows.columns if name.startswith("turnover_")])


@query
def rm_output(spark, sf):
    return regions.rm_output(_turnover(spark, sf), PRINTED_QUARTER)


@query
def rm_output_latest(spark, sf):
    return regions.rm_table(saved_run(spark, sf).results, survey.local_units(spark, sf))


@query
def quarterly_extract(spark, sf):
    return regions.quarterly_extract(
        _thousands(spark, sf), survey.region_names(spark), PRINTED_QUARTER)


@query
def outputs_registry(spark, sf):
    """Every additional output written to files, with the number of its rows."""
    options = additional.OutputOptions(repair_output=True)
    entries = additional.registry(S, options, survey.local_units(spark, sf))
    store = RunStore(spark, "outputs")
    written = additional.write_outputs(
        _thousands(spark, sf), entries, store.path("main"), store.path("replication"))
    counts = None
    for name, path in written.items():
        rows = spark.read.option("header", entries[name].header).schema("line string").csv(
            path).agg(F.lit(name).alias("output"), F.count("*").alias("n_rows"))
        counts = rows if counts is None else counts.union(rows)
    return counts


# ---- gates ---------------------------------------------------------------------------
@query
def gate_staging(spark, sf):
    return gates.gate_staging(saved_run(spark, sf).staged)


@query
def gate_imputation(spark, sf):
    return gates.gate_imputation(saved_run(spark, sf).imputed)


@query
def gate_estimation(spark, sf):
    return gates.gate_estimation(saved_run(spark, sf).weighted)


@query
def gate_outliers(spark, sf):
    return gates.gate_outliers(saved_run(spark, sf).trimmed)
