"""The pipeline stage by stage, each against a plain version over the rows it was given."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tallyworks.llm import language, toxicity
from tallyworks.llm.mixing import mix_sources
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.001"
CLEAN = "Only with the of and that when this was from there, in the ound of her thing "
PLANTED = [
    (900_001, CLEAN * 12, "en"), (900_002, (CLEAN * 12).upper(), "en"),
    (900_003, CLEAN * 11 + "and so on it went", "en"), (900_004, "12 34 !!", "en"),
    (900_005, None, "en"), (900_006, "", None), (900_007, "Мы были там, где никто не был", None)]


@pytest.fixture(scope="module")
def stages(spark, documents):
    rows = [(i, text, lang, "planted", len(text or "")) for i, text, lang in PLANTED]
    docs = documents.unionByName(spark.createDataFrame(rows, documents.schema))
    seen = [docs.toPandas()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/rows-{len(seen)}"
        docs.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs.toPandas())
    return seen


def ids(table):
    return sorted(table["doc_id"].tolist())


def texts(table):
    return dict(zip(table["doc_id"], table["text"]))


def test_language(spark, stages):
    before, after = stages[:2]
    model = language.learn(spark.createDataFrame(before))
    weight = {code: row for code, row in zip(model.features.tolist(), model.weights)}

    def spoken(text):
        if not text or not any(c.isalpha() for c in text):
            return False
        found = [weight[c] for c in set(language.ngrams(text).tolist()) if c in weight]
        return bool(found) and (sum(found) > 0).any()
    assert ids(after) == sorted(i for i, text in texts(before).items() if spoken(text))
    assert {900_001, 900_002, 900_003} <= set(ids(after))
    assert not {900_004, 900_005, 900_006} & set(ids(after))


def test_toxicity(spark, stages):
    before, after = stages[1:3]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = toxicity.score_documents(spark.createDataFrame(before), labels)
    assert ids(after) == sorted(r.doc_id for r in scored.filter("predicted = 0").collect())


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_copies(stages):
    before, after = stages[2:4]
    sets = {i: shingles(text) for i, text in texts(before).items()}
    first = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = sorted((first[a], first[b]), reverse=True)
                first = {i: new if x == old else x for i, x in first.items()}
    assert ids(after) == sorted(i for i in sets if first[i] == i)
    assert 900_002 not in ids(after)


def test_mixing(spark, stages):
    before, after = stages[3:5]
    mixed = mix_sources(spark.createDataFrame(before)).filter(F.col("size") > 0)
    taken = {r.doc_id: r.taken / r["size"] for r in mixed.collect()}
    times = Counter(ids(after))
    assert all(abs(times[i] - share) < 1 for i, share in taken.items())
    assert set(times) <= set(ids(before)) and max(times.values()) <= 3


def test_bpe(stages):
    before, after = stages[4:]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, text in zip(before["doc_id"], before["text"]):
        found = library.encode(text or "", add_special_tokens=False).ids
        written = " ".join(map(str, found))
        want[i, len(found), hashlib.sha256(written.encode()).hexdigest()] += 1
    assert Counter(zip(after["doc_id"], after["n_tokens"], after["ids_sha256"])) == want
