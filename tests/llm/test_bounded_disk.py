"""What a step leaves on disk, and what goes to the driver, does not grow with all steps."""

from pyspark.sql import functions as F

from tallyworks.llm import jaccard, topk_search
from tallyworks.sources.shared import settle


def shuffled(spark) -> set[str]:
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    blocks = store.getAllBlocks()
    names = (blocks.apply(i).name() for i in range(blocks.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = shuffled(spark)
    kept = settle(spark.range(1000).repartition(4, "id"), "dropped")
    assert not shuffled(spark) - before
    assert kept.count() == 1000


def test_more_pairs_than_texts_are_verified_in_slices(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRS", 1)
    words = " ".join(f"w{i}" for i in range(40))
    texts = spark.createDataFrame(
        [(1, words), (2, words + " more"), (3, "quite another text of a few words"), (4, words)],
        "doc_id long, text string")
    ids = texts.select(F.col("doc_id").alias("a"))
    pairs = ids.crossJoin(ids.withColumnRenamed("a", "b")).filter("a < b")
    found = jaccard._pairs_verified(pairs, texts, 80)
    assert sorted(map(tuple, found.collect())) == [(1, 2), (1, 4), (2, 4)]
    assert found._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2


def test_queries_are_not_sent_once_per_block_of_vectors(spark, monkeypatch):
    table = spark.range(400).select(
        F.col("id").alias("vec_id"),
        F.array(*[F.sin(F.col("id") * (i + 1)).cast("float") for i in range(8)]).alias("embedding"))
    whole = sorted(map(tuple, topk_search.search(table, every=5).collect()))
    # One block of queries at a time, which then are several.
    monkeypatch.setattr(topk_search, "SENT", 1)
    parts = topk_search.search(table, every=5, block_rows=50, block_queries=16)
    assert sorted(map(tuple, parts.collect())) == whole and len(whole) == 400
    packed = topk_search._packed(table.select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector"),
        F.lit(0.0).alias("cutoff")), 8, "blocks")
    cells = list(topk_search._cells(packed, packed))
    assert len(cells) == 8
    assert all("explode" not in cell._jdf.queryExecution().toString() for cell in cells)
