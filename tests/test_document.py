"""Documents read by several tasks, whatever stands at the borders of their blocks."""

from __future__ import annotations

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyworks.sources import document
from tallyworks.sources.snapshot import read_snapshot_records

NASTY = ['}', '{', '"', '\\', '\\"', ', {"', '"contributors": [{', 'é', '\n', ']', 'a}b}{c', '']


def snapshot(rows: int, seed: int = 1) -> dict:
    draw = random.Random(seed)

    def text():
        return "".join(draw.choice(NASTY) for _ in range(draw.randrange(6)))
    return {
        "snapshot_id": text(), "contributors": [
            {"reference": i, "period": 202301, "status": text(), "statusencoded": "210"}
            for i in range(rows)],
        "note}": text(), "responses": [
            {"reference": i, "period": 202301, "questioncode": 40 + i % 3, "response": text(),
             "adjustedresponse": None if i % 7 == 0 else i / 4} for i in range(2 * rows)]}


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("block", [64, 1000, 1 << 27])
def test_blocks_of_any_size(spark, tmp_path, block, indent):
    whole = snapshot(60)
    path = tmp_path / "snapshot.json"
    path.write_text(json.dumps(whole, indent=indent, ensure_ascii=False), encoding="utf-8")
    before = [(name, spark.conf.get(name)) for name in (
        "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")]
    try:
        for name, _ in before:
            spark.conf.set(name, block)
        units, rows = read_snapshot_records(spark, str(path))
        found = units.collect(), rows.collect()
        tasks = document.read_records(spark, str(path)).rdd.getNumPartitions()
    finally:
        for name, value in before:
            spark.conf.set(name, value)
    assert tasks > 1 or block > path.stat().st_size
    assert sorted((r.reference, r.status, r.statusencoded) for r in found[0]) == [
        (r["reference"], r["status"], 210) for r in whole["contributors"]]
    assert sorted(tuple(r) for r in found[1]) == sorted(
        (r["reference"], r["period"], r["questioncode"], r["response"], r["adjustedresponse"])
        for r in whole["responses"])


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.lists(st.integers(1, 400), max_size=8), st.integers(0, 6))
def test_cut_anywhere(seed, cuts, rows):
    """The two passes over any cutting of the pieces into blocks."""
    import pyarrow as pa
    whole = snapshot(rows, seed)
    pieces = json.dumps(whole).split("}")
    pieces = pieces if pieces[-1] else pieces[:-1]
    blocks, at = [], 0
    for cut in [*cuts, len(pieces)]:
        if at < len(pieces):
            blocks += [("f", len(blocks), piece) for piece in pieces[at:at + cut]] and [
                ("f", at, piece) for piece in pieces[at:at + cut]]
        at += cut
    table = pa.RecordBatch.from_pydict({
        "path": [b[0] for b in blocks], "start": [b[1] for b in blocks],
        "value": [b[2] for b in blocks]})
    facts = [r for b in document._facts(iter([table])) for r in b.to_pylist()]
    begins = document.settle_blocks(facts)
    found = [r for b in document._records(begins)(iter([table])) for r in b.to_pylist()]
    assert [(r["part"], json.loads(r["record"])) for r in found] == [
        (part, record) for part in ("contributors", "responses") for record in whole[part]]


def test_many_files_and_empty_lists(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps(snapshot(i)))
    units, rows = read_snapshot_records(spark, str(tmp_path))
    assert (units.count(), rows.count()) == (3, 6)


def test_broken_document_raises(spark, tmp_path):
    text = json.dumps(snapshot(5))
    for cut in (text[:-40], text.replace('"reference": 3', '"reference" 3')):
        path = tmp_path / f"{len(cut)}.json"
        path.write_text(cut)
        with pytest.raises(Exception):
            read_snapshot_records(spark, str(path))[1].collect()
            read_snapshot_records(spark, str(path))[0].collect()
