"""Bounded samples of labelled documents, and rows carried through a classifier."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tallyworks.llm.shingles import slices
from tallyworks.llm.workers import let_go
from tallyworks.sources.shared import settle

HELD_OUT = 2


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    """Rows no classifier learns from.  A null doc_id is not held out, nor learned from."""
    return F.coalesce(remainder(doc_id) == HELD_OUT, F.lit(False))


def sample_texts(docs: DataFrame, labels: DataFrame, per_label: int,
                 longest: int) -> list[tuple[str, object]]:
    """(text, label) of at most ``per_label`` documents a label, in hashed order of doc_id.

    ``labels`` has doc_id and label, null labels and held-out rows go; of several labels of a
    document the least counts.  Texts over ``longest`` characters are not sampled, so that the
    sample is bounded in bytes too; neither they nor empty, null or missing ones take a place.
    A histogram of the hashes, in eighths of powers of two, tells how far the places reach, so
    that only about as many rows as are taken are ranked.
    """
    sampled = docs.filter(F.length("text").between(1, longest))
    learnable = labels.filter(
        F.col("label").isNotNull() & (remainder(F.col("doc_id")) != HELD_OUT)
    ).select(F.col("doc_id").alias("_id"), "label")
    share = (F.col("_hash").cast("double") + 2.0 ** 63) / 2.0 ** 64
    ids = settle(
        learnable.join(sampled.select("doc_id"), F.col("_id") == F.col("doc_id"), "left_semi")
        .groupBy("_id").agg(F.min("label").alias("label"))
        .withColumn("_hash", F.xxhash64(F.col("_id").cast("string")))
        .withColumn("_level", F.floor(-8 * F.log2(F.greatest(share, F.lit(2.0 ** -64))))),
        "sample-ids")
    levels = ids.groupBy("label", "_level").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.sum("_n").over(W.partitionBy("label").orderBy(F.desc("_level"))) - F.col("_n"))
    least = levels.filter(F.col("_before") < per_label).groupBy(F.col("label").alias("_label")).agg(
        F.min("_level").alias("_least"))
    near = ids.join(F.broadcast(least), (F.col("label") == F.col("_label"))
                    & (F.col("_level") >= F.col("_least")))
    place = F.row_number().over(W.partitionBy("label").orderBy("_hash", "_id"))
    chosen = near.withColumn("_place", place).filter(F.col("_place") <= per_label).select(
        "_id", "label")
    texts = (sampled.select("doc_id", "text")
             .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
             .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
             .orderBy("doc_id"))
    return [(row.text, row.label) for row in texts.collect()]


def classify(docs: DataFrame, score: Callable[[], Callable[[list[str | None]], dict]],
             names: tuple[str, ...], kinds: str) -> DataFrame:
    """``docs`` as one column ``row``, and what ``score()`` makes of each text beside it.

    ``score`` is called once a task; what it returns takes texts and gives lists by name.
    """
    place = docs.columns.index("text")

    def beside(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The rows, and their texts as they lie in them: a worker is sent each text once."""
        return pa.RecordBatch.from_arrays([batch["row"], batch["row"].field(place)],
                                          ["row", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        of_texts = score()
        for batch in slices(map(beside, batches)):
            found = of_texts(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["row"], *[pa.array(found[name]) for name in names]], ["row", *names])

    carried = docs.select(F.struct("*").alias("row"))
    schema = T.StructType([carried.schema["row"], *T.StructType.fromDDL(kinds).fields])
    return carried.mapInArrow(run, schema)
