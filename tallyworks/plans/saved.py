"""Stage tables of a run over the order tables, written once per application.

Output jobs start from saved results, not from the returns.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallyworks import constants as c
from tallyworks.operators import imputation
from tallyworks.operators.outputs import results_table
from tallyworks.plans import stages
from tallyworks.sources import order_survey as survey
from tallyworks.sources.store import RunStore


class SavedRun:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.store = RunStore(spark, "saved")
        self.inputs = survey.inputs(spark, sf_dir)
        self.settings = survey.SETTINGS

    @cached_property
    def _staged(self) -> stages.Staged:
        i = self.inputs
        return stages.stage_panel(
            i.responses, i.contributors, i.frame, self.settings, i.manual, self.store.keep)

    @cached_property
    def staged(self) -> DataFrame:
        return self.store.keep(self._staged.panel, "staged", by=c.REFERENCE)

    @cached_property
    def links(self) -> DataFrame:
        return self.store.keep(imputation.link_table(self.staged), "links_table")

    @cached_property
    def chained(self) -> DataFrame:
        """Ratio-of-means result, back data included."""
        rows = imputation.ratio_of_means(
            self.staged, self.settings, self.inputs.manual,
            keep=lambda df, name: self.links)
        return self.store.keep(rows, "chained", by=c.REFERENCE)

    @cached_property
    def imputed(self) -> DataFrame:
        rows = stages.impute_panel(
            self.staged, self.settings, self.inputs.manual, keep=lambda df, name: self.links)
        return self.store.keep(rows, "imputed", by=c.REFERENCE)

    @cached_property
    def weighted(self) -> DataFrame:
        return self.store.keep(stages.weighted_panel(
            self.imputed, self.inputs, self.settings, self.store.keep), "weighted",
            by=c.REFERENCE)

    @cached_property
    def trimmed(self) -> DataFrame:
        return self.store.keep(stages.trimmed_panel(
            self.weighted, self.inputs, self.settings, self.store.keep), "trimmed",
            by=c.REFERENCE)

    @cached_property
    def results(self) -> DataFrame:
        return self.store.keep(
            results_table(self.trimmed, self._staged.unprocessed), "results")


_RUNS: dict[tuple[str, str], SavedRun] = {}


def saved_run(spark: SparkSession, sf_dir: str) -> SavedRun:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        _RUNS[key] = SavedRun(spark, sf_dir)
    return _RUNS[key]
