"""Snapshots of contributors and responses in JSON, as records or as columns.

A snapshot is one JSON object.  It may be a single document, which is split at its records
(document.py) if it lists records and read by one task if it lists columns; or a folder of text
files with one object per line, each holding a bounded number of rows, so that reading and
writing split over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyworks.sources import document
from tallyworks.sources.shared import settle

CONTRIBUTOR_FIELDS = ("reference", "period", "status", "statusencoded")
RESPONSE_FIELDS = ("reference", "period", "questioncode", "response", "adjustedresponse")
FIELD_TYPES = {
    "reference": "bigint", "period": "int", "questioncode": "int", "statusencoded": "int",
    "adjustedresponse": "double", "cellnumber": "int", "frozenturnover": "double",
    "frozenemployees": "int",
}


def _scalar(value: Column, name: str) -> Column:
    """Snapshot scalars arrive as text; a written NaN means missing."""
    value = F.when(value != "NaN", value)
    kind = FIELD_TYPES.get(name)
    if kind in ("int", "bigint"):
        # Whole numbers may have been written with a decimal point.
        return F.coalesce(value.try_cast(kind), value.try_cast("double").try_cast(kind))
    return value.try_cast(kind) if kind else value


def _record(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in fields])


def _columns(fields: Sequence[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, T.ArrayType(T.StringType())) for name in fields])


def _read(spark: SparkSession, path: str, parts: dict[str, T.DataType], lines: bool) -> DataFrame:
    schema = T.StructType([T.StructField(name, kind) for name, kind in parts.items()])
    # A broken object fails the read; its rows are not left out.
    return (spark.read.schema(schema).option("multiLine", not lines)
            .option("mode", "FAILFAST").json(path))


def read_snapshot_records(
        spark: SparkSession, path: str, lines: bool = False,
        contributor_fields: Sequence[str] = CONTRIBUTOR_FIELDS,
        response_fields: Sequence[str] = RESPONSE_FIELDS) -> tuple[DataFrame, DataFrame]:
    """(contributors, responses) of snapshots that list records.

    A single document is read by as many tasks as its bytes fill, and once for both parts.
    """
    if not lines:
        return _document_parts(spark, path, contributor_fields, response_fields)

    def part(name: str, fields: Sequence[str]) -> DataFrame:
        # Each part is read with its own schema, so the other one is not parsed.
        objects = _read(spark, path, {name: T.ArrayType(_record(fields))}, lines)
        rows = objects.select(F.explode(name).alias("_r"))
        return rows.select(*[_scalar(F.col("_r").getField(f), f).alias(f) for f in fields])
    return part("contributors", contributor_fields), part("responses", response_fields)


def _document_parts(spark: SparkSession, path: str, contributor_fields: Sequence[str],
                    response_fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    records = settle(document.read_records(spark, path), "records")

    def part(name: str, fields: Sequence[str]) -> DataFrame:
        rows = records.where(F.col("part") == name).select(
            F.from_json("record", _record(fields), {"mode": "FAILFAST"}).alias("_r"))
        return rows.select(*[_scalar(F.col("_r").getField(f), f).alias(f) for f in fields])
    return part("contributors", contributor_fields), part("responses", response_fields)


def read_snapshot_columnar(
        spark: SparkSession, path: str, lines: bool = False,
        contributor_fields: Sequence[str] = CONTRIBUTOR_FIELDS,
        response_fields: Sequence[str] = RESPONSE_FIELDS) -> tuple[DataFrame, DataFrame]:
    """(contributors, responses) of snapshots that hold one list per field."""
    def part(name: str, fields: Sequence[str]) -> DataFrame:
        objects = _read(spark, path, {name: _columns(fields)}, lines)
        zipped = F.arrays_zip(*[F.col(name).getField(f).alias(f) for f in fields])
        rows = objects.where(F.col(name).isNotNull()).select(F.explode(zipped).alias("_r"))
        return rows.select(*[_scalar(F.col("_r").getField(f), f).alias(f) for f in fields])
    return part("contributors", contributor_fields), part("responses", response_fields)


def _field(name: str):
    return lambda row: row[name]


def _objects(df: DataFrame, part: str, snapshot_id: str, columnar: bool,
             rows_per_object: int) -> DataFrame:
    """JSON text of ``df`` in objects of about ``rows_per_object`` rows."""
    # Dealt by what a row holds, so a task that runs again deals its rows alike.
    count = max(1, math.ceil(df.count() / rows_per_object))
    chunks = df.withColumn("_chunk", F.pmod(F.xxhash64(*df.columns), F.lit(count))).groupBy(
        "_chunk").agg(F.collect_list(F.struct(*df.columns)).alias("rows"))
    body = F.col("rows")
    if columnar:
        body = F.struct(*[
            F.transform("rows", _field(name)).alias(name) for name in df.columns])
    return chunks.select(F.to_json(
        F.struct(F.lit(snapshot_id).alias("snapshot_id"), body.alias(part)),
        {"ignoreNullFields": "false"}).alias("value"))


def write_snapshot(contributors: DataFrame, responses: DataFrame, path: str,
                   snapshot_id: str, columnar: bool = True,
                   rows_per_object: int = 10_000) -> None:
    """A snapshot as text lines, one bounded JSON object each."""
    (_objects(contributors, "contributors", snapshot_id, columnar, rows_per_object)
     .union(_objects(responses, "responses", snapshot_id, columnar, rows_per_object))
     .write.mode("errorifexists").text(path))
