"""Outputs produced from a saved results table, and the job that writes them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallyworks import constants as c
from tallyworks.operators import outputs, regions
from tallyworks.settings import SurveySettings
from tallyworks.sources import sinks

MANDATORY = ("produce_qa_output", "imputes_and_constructed_output", "cord_output")


@dataclass(frozen=True)
class OutputOptions:
    """Choices of the additional outputs job."""

    contribution_periods: tuple[int, ...] = ()
    sizeband_quarters: tuple[str, ...] = ()
    repair_output: bool = False
    repair_quarter: str | None = None


@dataclass(frozen=True)
class Output:
    """How one output is computed and written."""

    compute: Callable[[DataFrame], DataFrame | None]
    header: bool = True
    by_period: bool = False
    replicated: bool = False


def months_of(results: DataFrame) -> list[int]:
    """The months results hold, whatever window the settings name."""
    return [row[0] for row in results.select(c.PERIOD).where(
        F.col(c.PERIOD).isNotNull()).distinct().orderBy(c.PERIOD).collect()]


def registry(settings: SurveySettings, options: OutputOptions = OutputOptions(),
             local_units: DataFrame | None = None) -> dict[str, Output]:
    def repair(results: DataFrame) -> DataFrame | None:
        if options.repair_output is not True or local_units is None:
            return None
        return regions.rm_table(results, local_units, options.repair_quarter)

    return {
        "imputes_and_constructed_output": Output(
            lambda df: outputs.constructed(df, settings), replicated=True),
        "quarterly_by_sizeband_output": Output(
            lambda df: outputs.sizeband(df, settings.components, options.sizeband_quarters),
            header=False),
        "produce_qa_output": Output(
            lambda df: outputs.qa_output(df, settings), header=False, by_period=True),
        "imputation_contribution_output": Output(
            lambda df: outputs.imputation_contribution(
                df, settings.components, options.contribution_periods)),
        "cord_output": Output(lambda df: outputs.cord(df, months_of(df), settings)),
        "r_m_output": Output(repair, header=False),
    }


def compute_outputs(results: DataFrame, entries: dict[str, Output],
                    names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The named outputs, all of them by default; those switched off are left out."""
    chosen = list(entries) if names is None else list(names)
    frames = {name: entries[name].compute(results) for name in chosen}
    return {name: df for name, df in frames.items() if df is not None}


def write_outputs(results: DataFrame, entries: dict[str, Output], path: str,
                  replication_path: str, names: Iterable[str] | None = None) -> dict[str, str]:
    """Compute and write outputs; returns where each one lies."""
    written = {}
    for name, df in compute_outputs(results, entries, names).items():
        entry = entries[name]
        target = f"{replication_path if entry.replicated else path}/{sinks.folder_name(name)}"
        if entry.by_period:
            sinks.write_by_period(df, target, entry.header)
        else:
            sinks.write_csv(df, target, entry.header)
        written[name] = target
    return written
