"""Legacy question and contributor files to a snapshot."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tallyworks import constants as c
from tallyworks.operators import legacy
from tallyworks.functions.expressions import is_in
from tallyworks.sources.snapshot import write_snapshot


def convert_legacy(questions: DataFrame, contributors: DataFrame, frame: DataFrame,
                   no_values: Iterable) -> tuple[DataFrame, DataFrame]:
    """(contributors, responses) of the snapshot that the legacy files stand for."""
    rows = legacy.routing(questions, no_values, question="question_no",
                          value="adjusted_value")
    rows = rows.where(~is_in("question_no", c.ROUTING_QUESTIONS))
    rows = legacy.drop_nil(rows, contributors)
    responses = legacy.legacy_responses(rows).select(
        *c.CELL_KEY, F.col("response").cast("string").alias("response"), c.TARGET)
    units = legacy.legacy_contributors(contributors).select(*c.UNIT, "status", "statusencoded")
    return legacy.join_sample(units, frame), responses


def legacy_snapshot(questions: DataFrame, contributors: DataFrame, frame: DataFrame,
                    no_values: Iterable, path: str, snapshot_id: str) -> None:
    units, responses = convert_legacy(questions, contributors, frame, no_values)
    write_snapshot(units, responses, path, snapshot_id, columnar=True)
