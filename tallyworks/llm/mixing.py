"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

The words a mix may hold are cut in blocks of equal size.  Blocks are seats: each goes to
the source with the highest quotient target / (2 k + 1), k being the blocks it has, and the
blocks of a source go to its shards in the same way.  A shard lays its documents out in a
seeded order and takes its quota from the front, passing over all its blocks again where
the quota exceeds them.

The quotients are not listed one by one: rounding with a divisor just above and just below
the right one bounds each party's seats, so that only about four quotients a party compete.

Defined results: null or empty text has size 0 and takes 0; null source is a source of its
own, last in order; repeated rows count as often as they occur; without any word every
target is 0; an empty table gives no rows.  Columns besides doc_id, text and source are not
read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyworks.sources.shared import settle

WORD = r"[^\x20\x09-\x0D]+"


def apportion(table: DataFrame, party: list[str], votes: str, seats: str,
              group: list[str] = ()) -> DataFrame:
    """``quota`` of each party of each group: its share of ``seats`` by highest quotients.

    Ties go to the party first in order, nulls last.  Parties without votes are left out.
    """
    whole, party, group = W.partitionBy(*group), list(party), list(group)
    half = F.col("_parties") / 2 + 1
    share = F.col(votes) / F.col("_votes")
    bounds = (
        table.filter(F.col(votes) > 0)
        .withColumn("_parties", F.count(F.lit(1)).over(whole))
        .withColumn("_votes", F.sum(votes).over(whole))
        .withColumn("_low", F.greatest(F.lit(0).cast("long"),
                                       F.floor(share * (F.col(seats) - half) + 0.5) - 1))
        .withColumn("_high", F.floor(share * (F.col(seats) + half) + 0.5) + 1)
        .withColumn("_left", F.col(seats) - F.sum("_low").over(whole))
    )
    quotients = bounds.withColumn("_k", F.explode(F.sequence("_low", "_high"))).withColumn(
        "_quotient", F.col(votes).cast("double") / (2 * F.col("_k") + 1))
    best = W.partitionBy(*group).orderBy(
        F.desc("_quotient"), *[F.asc_nulls_last(name) for name in party], "_k")
    won = (F.row_number().over(best) <= F.col("_left")).cast("long")
    return (quotients.withColumn("_won", won).groupBy(*group, *party)
            .agg((F.min("_low") + F.sum("_won")).alias("quota")))


def _targets(sources: DataFrame, weights: tuple[int, ...], share: float, repeats: int,
             block_words: int) -> DataFrame:
    """Target of each source: weight times one level, or ``repeats`` times its size if less.

    With sources in order of cap / weight, the level at each is what remains after the caps
    before it, shared over the weights from it on; the right level is the largest of these.
    One row a source passes through these windows.
    """
    every, ranked = W.partitionBy(), W.orderBy(F.asc_nulls_last("source"))
    weight = F.get(F.array(*[F.lit(w) for w in weights]),
                   (F.row_number().over(ranked) - 1) % len(weights))
    filled = W.orderBy(F.col("_cap") / F.col("_weight"), F.asc_nulls_last("source"))
    before = F.coalesce(
        F.sum("_cap").over(filled.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("_weight").over(filled.rowsBetween(0, W.unboundedFollowing))
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(every)
    return (
        sources.withColumn("_weight", weight)
        .withColumn("_cap", F.col("source_size") * repeats)
        .withColumn("_total", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("_level", F.max((F.col("_total") - before) / after).over(every))
        .withColumn("target", F.least(F.col("_cap").cast("double"),
                                      F.col("_weight") * F.col("_level")))
        .withColumn("_block", F.greatest(F.lit(1).cast("long"), F.least(
            F.lit(block_words).cast("long"),
            F.coalesce(F.floor(least / block_words), F.lit(1).cast("long")))))
        .withColumn("_seats", F.round(F.col("_total") / F.col("_block")).cast("long"))
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _bucket(order: Column, shards: Column) -> Column:
    return F.conv(F.substring(order, 1, 8), 16, 10).cast("long") % shards


def _order(seed: int) -> Column:
    """Seeded place of a document, the same in every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"),
                          F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _plan(docs: DataFrame, weights: tuple[int, ...], share: float, repeats: int,
          block_words: int, shard_words: int, shards: int, seed: int,
          ) -> tuple[DataFrame, DataFrame]:
    """Sources with their number of shards, and documents with what they give."""
    sized = settle(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        _order(seed).alias("_order")), "mix-sizes")
    sources = _targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")),
                       weights, share, repeats, block_words)
    quotas = apportion(sources, ["source"], "target", "_seats").withColumnRenamed(
        "source", "_source")
    sources = settle(sources.join(
        quotas, sources.source.eqNullSafe(quotas._source), "left").select(
        F.col("source").alias("_source"), "source_size", "target", "_block",
        F.coalesce("quota", F.lit(0)).alias("_quota"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.greatest(
            F.lit(shard_words), F.col("_total") / shards))).cast("long").alias("_shards")),
        "mix-sources")
    dealt = sized.join(sources, sized.source.eqNullSafe(sources._source)).withColumn(
        "_shard", _bucket(F.col("_order"), F.col("_shards"))).drop("_source")

    totals = dealt.groupBy("source", "_shard").agg(
        F.sum("size").alias("_words"), F.min("_quota").alias("_quota"),
        F.min("_block").alias("_block"))
    blocks = F.ceil(F.col("_words") / F.col("_block"))
    quota = F.least(F.col("quota"), blocks * repeats)
    passes = settle(
        apportion(totals, ["_shard"], "_words", "_quota", ["source"])
        .withColumnsRenamed({"source": "_source", "_shard": "_part"})
        .join(totals, F.col("_source").eqNullSafe(F.col("source"))
              & (F.col("_part") == F.col("_shard")))
        .select("_source", "_part", F.floor(quota / blocks).alias("_passes"),
                (quota % blocks * F.col("_block")).alias("_front")), "mix-shards")
    layout = (W.partitionBy("source", "_shard").orderBy("_order", "doc_id", "size")
              .rowsBetween(W.unboundedPreceding, -1))
    placed = dealt.withColumn("_before", F.coalesce(F.sum("size").over(layout), F.lit(0)))
    rest = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_front") - F.col("_before")))
    taken = F.coalesce(F.col("_passes") * F.col("size") + rest, F.lit(0)).cast("long")
    mixed = placed.join(
        passes, placed.source.eqNullSafe(passes._source)
        & (placed._shard == passes._part), "left").withColumn("taken", taken)
    return sources, mixed


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0,
                repeats: int = 3, block_words: int = 64, shard_words: int = 50_000,
                shards: int = 50_000, seed: int = 42) -> DataFrame:
    """Words each document gives to a mix: doc_id, size, source, source_size, target, taken.

    ``weights`` go to the sources in order of code points and repeat; the mix has ``share``
    times all words; no source passes ``repeats`` times its size.  A block has
    ``block_words`` words, or fewer where the smallest target would be under that many
    blocks.  A shard has about ``shard_words`` words, or more where that would make over
    ``shards`` of them, so a hot source is dealt over many tasks.
    """
    return _plan(docs, weights, share, repeats, block_words, shard_words, shards, seed)[1].select(
        "doc_id", "size", "source", "source_size", "target", "taken")


def repeat_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0,
                     repeats: int = 3, block_words: int = 64, shard_words: int = 50_000,
                     shards: int = 50_000, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, parts of a document rounded.

    A shard takes its documents up to one place in its order once more than the rest, so
    the rows meet a row per shard and are not shuffled by document.
    """
    sources, mixed = _plan(docs, weights, share, repeats, block_words, shard_words, shards, seed)
    more = F.round(F.col("taken") / F.col("size")) > F.col("_passes")
    cuts = settle(mixed.filter("size > 0").groupBy("source", "_shard").agg(
        F.coalesce(F.min("_passes"), F.lit(0)).alias("_passes"),
        F.max(F.when(more, F.col("_order"))).alias("_last")).withColumnsRenamed(
        {"source": "_source", "_shard": "_part"}), "mix-cuts")
    sources = sources.select(F.col("_source").alias("_name"), "_shards")
    row = docs.select(F.struct("*").alias("_row"), F.col("source").alias("_from"),
                      _order(seed).alias("_order"),
                      F.col("text").rlike(WORD).alias("_words")).filter("_words")
    row = row.join(sources, F.col("_from").eqNullSafe(F.col("_name")))
    row = row.join(cuts, F.col("_from").eqNullSafe(F.col("_source"))
                   & (_bucket(F.col("_order"), F.col("_shards")) == F.col("_part")))
    once_more = F.coalesce(F.col("_order") <= F.col("_last"), F.lit(False)).cast("long")
    copies = F.col("_passes") + once_more
    return row.filter(copies > 0).select(
        "_row", F.explode(F.sequence(F.lit(1).cast("long"), copies))).select("_row.*")
