"""What classifiers learn from: no held-out row, and as many texts as there are."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F
from tallyworks.llm import toxicity
from tallyworks.llm.samples import HELD_OUT, classify, remainder, sample_texts

ROWS = 400


def hashed(spark):
    """doc_id, remainder and hash of documents."""
    return spark.range(ROWS).select(
        F.col("id"), remainder(F.col("id")).alias("left"),
        F.xxhash64(F.col("id").cast("string")).alias("hash")).collect()


def test_shares_leave_out_held_out_rows(spark, monkeypatch):
    """Held-out rows and rows without a document are all toxic, the others mostly not."""
    rows = [(r.id, 0, int(r.left == HELD_OUT or r.id % 5 == 0)) for r in hashed(spark)]
    gone = [(ROWS + i, 0, 1) for i in range(100)]
    labels = spark.createDataFrame(rows + gone, "doc_id long, quality int, toxic int")
    docs = spark.range(ROWS).selectExpr("id AS doc_id", "concat('some words ', id) AS text")
    told = []
    monkeypatch.setattr(toxicity, "train", lambda sample, shares: told.append(shares))
    toxicity.learn(docs, labels)
    learnt = Counter(row[2] for row, r in zip(rows, hashed(spark)) if r.left != HELD_OUT)
    assert told == [{label: n / learnt.total() for label, n in learnt.items()}]


def test_texts_that_cannot_be_sampled_take_no_place(spark):
    """The smallest hashes belong to texts that are long, empty, null or not there."""
    rows = sorted(hashed(spark), key=lambda r: r.hash)
    odd = ["long " * 10, "", None, "missing"]
    texts = {r.id: odd[at % 4] if at < ROWS // 2 else f"t{r.id}" for at, r in enumerate(rows)}
    docs = spark.createDataFrame(
        [(i, t) for i, t in texts.items() if t != "missing"] + [(rows[-1].id, "u")],
        "doc_id long, text string")
    labels = spark.createDataFrame(
        [(r.id, r.id % 2) for r in rows] + [(rows[0].id, None), (rows[-1].id, 1), (None, 1)],
        "doc_id long, label int")
    whole = [r.id for r in rows[ROWS // 2:] if r.left != HELD_OUT]
    of = {i: i % 2 for i in whole}
    for per_label in (1, 7, 40, 1500):
        want = [i for label in (0, 1) for i in [i for i in whole if of[i] == label][:per_label]]
        found = sample_texts(docs, labels, per_label, 20)
        assert found == [(texts[i], of[i]) for i in sorted(want)]


def test_a_label_of_many_rows(spark):
    docs = spark.range(60_000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    found = sample_texts(docs, docs.selectExpr("doc_id", "'x' AS label"), 1500, 20)
    hashes = docs.filter(remainder(F.col("doc_id")) != HELD_OUT).orderBy(
        F.xxhash64(F.col("doc_id").cast("string"))).limit(1500).collect()
    assert found == [(r.text, "x") for r in sorted(hashes, key=lambda r: r.doc_id)]


def test_a_worker_is_sent_each_text_once(odd_documents):
    found = classify(odd_documents, lambda: lambda texts: {"got": texts}, ("got",), "got string")
    plan = found._jdf.queryExecution().analyzed()
    assert plan.children().head().output().size() == 1
    rows = found.collect()
    assert len(rows) == odd_documents.count() and all(r.got == r.row.text for r in rows)
