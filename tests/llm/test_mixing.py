"""Source mixing against a plain apportionment."""

from __future__ import annotations

import heapq
import re
from collections import defaultdict

from tallyworks.llm.mixing import apportion, mix_sources, repeat_documents


def seats_by_quotient(votes: dict, seats: int) -> dict:
    heap = [(-v, k, 0) for k, v in sorted(votes.items()) if v > 0]
    heapq.heapify(heap)
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        _, key, n = heapq.heappop(heap)
        won[key] += 1
        heapq.heappush(heap, (-votes[key] / (2 * n + 3), key, n + 1))
    return won


def test_quotas_go_by_highest_quotient(spark):
    for votes, seats in (({"a": 53.0, "b": 24.0, "c": 23.0}, 7), ({"a": 1.0, "b": 1.0}, 3),
                         ({f"s{i:02}": 1.0 + i * i for i in range(40)}, 900),
                         ({f"s{i}": 1.0 for i in range(9)}, 2), ({"a": 9.0, "b": 0.0}, 5)):
        table = spark.createDataFrame([(k, v, seats) for k, v in votes.items()],
                                      "p string, v double, n long")
        found = {r.p: r.quota for r in apportion(table, ["p"], "v", "n").collect()}
        assert found == {k: n for k, n in seats_by_quotient(votes, seats).items() if votes[k]}


def test_targets_are_met_and_capped(documents):
    rows = mix_sources(documents).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for row in rows:
        assert 0 <= row.taken <= 3 * row.size
        sizes[row.source] += row.size
        taken[row.source] += row.taken
        target[row.source] = row.target
    total = sum(sizes.values())
    assert abs(sum(target.values()) - total) < 1e-6 * total
    for source, size in sizes.items():
        assert target[source] <= 3 * size + 1e-6
        assert abs(taken[source] - target[source]) <= max(128, 0.05 * target[source])


def test_excess_over_three_times_goes_to_the_others(spark):
    rows = [(i, "w " * 100, "en", "a", 0) for i in range(40)] + [
        (100 + i, "w " * 10, "en", s, 0) for s in "bc" for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long")
    found = {r.source: r.target for r in mix_sources(docs).collect()}
    assert found == {"a": 4040 - 120, "b": 60, "c": 60}


def test_many_shards_repeat_and_agree(documents):
    runs = [sorted((r.doc_id, r.taken) for r in mix_sources(documents, shard_words=300).collect())
            for _ in range(2)]
    assert runs[0] == runs[1]


def test_odd_rows(odd_documents, no_documents):
    rows = mix_sources(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    for row, text in ((r, t) for r in rows for t in [None]):
        assert row.size or not row.taken
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].size == by_id[2].size == by_id[3].size == 0 and by_id[8].size == 6
    assert by_id[1].source is None and by_id[1].source_size == 3
    assert mix_sources(no_documents).count() == 0
    repeated = repeat_documents(odd_documents)
    assert repeated.columns == odd_documents.columns
    assert repeated.filter("doc_id in (1, 2, 3)").count() == 0
    assert repeat_documents(no_documents).count() == 0


def test_repeated_documents_follow_what_is_taken(documents):
    rows = mix_sources(documents).collect()
    copies = {r.doc_id: r["count"] for r in
              repeat_documents(documents).groupBy("doc_id").count().collect()}
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
             for r in documents.select("doc_id", "text").collect()}
    for row in rows:
        assert row.size == words[row.doc_id]
        if row.size:
            assert abs(copies.get(row.doc_id, 0) - row.taken / row.size) <= 0.5
