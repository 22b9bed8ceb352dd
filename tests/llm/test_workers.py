"""What Python workers keep between tasks."""

from __future__ import annotations

import public_tokenizers
from tallyworks.llm import workers
from tallyworks.llm.bpe import encode_documents
from tallyworks.llm.samples import classify


def test_one_thing_is_kept(monkeypatch):
    monkeypatch.setattr(workers, "_KEPT", {})
    first = workers.kept(list, "ab")
    assert workers.kept(list, "ab") is first == ["a", "b"]
    assert workers.kept(list, "c") == ["c"] and len(workers._KEPT) == 1
    workers.let_go()
    assert not workers._KEPT


def test_classifiers_do_not_run_beside_an_encoder(spark, documents):
    docs = documents.repartition(16).cache()
    rows = encode_documents(spark, docs, public_tokenizers.path("word_bpe_49k.json"), words=50)
    rows.write.format("noop").mode("overwrite").save()

    def count():
        from tallyworks.llm import workers
        return lambda texts: {"held": [len(workers._KEPT)] * len(texts)}
    held = classify(docs, count, ("held",), "held long").collect()
    docs.unpersist()
    assert {r.held for r in held} == {0}
