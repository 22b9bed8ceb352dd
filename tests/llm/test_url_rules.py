"""Given rules, and learned rules against all combinations."""

from __future__ import annotations

from itertools import combinations

import pytest
from tallyworks.llm.url_rules import judge_urls, learn_rules, match_rules

CASES = [
    ("https://A.Example.NET/en/x?y#z", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://example.net/enx", "example.net", "/enx", "net/", "block"),
    ("http://example.net", "example.net", "", None, None),
    ("http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("http://x.example.com/de", "x.example.com", "/de", None, None),
    ("ftp://org/fr/?a", "org", "/fr/", "org/fr/", "allow"),
    ("http://a.org?/fr/", "a.org", "", None, None),
    ("a://b://c/net/", "b:", "//c/net/", None, None),
    ("example.net/en/", "", "", None, None), ("", "", "", None, None), (None, "", "", None, None),
    ("http://ÄB.net/É", "Äb.net", "/É", "net/", "block"), ("://net/", "net", "/", "net/", "block"),
]


def test_given_rules(spark):
    rows = [(i, case[0], "x") for i, case in enumerate(CASES)] + [(None, "http://a.net/", "x")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string").selectExpr(
        "*", "1 AS tokens", "2 AS verdict", "3 AS host")
    found = {r.page_id: r for r in judge_urls(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        row = found[i]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict or verdict is None and row.verdict in ("allow", "block")
    assert judge_urls(pages).count() == len(rows)
    assert judge_urls(pages.filter("false")).count() == 0
    assert {r.verdict for r in judge_urls(pages.filter("page_id = 5")).collect()} == {"allow"}


def brute_force(baskets, min_support, min_confidence):
    labelled = [(frozenset(t), v) for t, v in baskets if v]
    sets = {frozenset(c) for t, _ in labelled for n in range(1, len(t) + 1)
            for c in combinations(sorted(t), n)}
    rules = {}
    for items in sets:
        held = [v for t, v in labelled if items <= t]
        for verdict in set(held):
            hits = held.count(verdict)
            if hits >= min_support * len(labelled) and hits / len(held) >= min_confidence:
                rules[items, verdict] = (hits / len(held), hits / len(labelled))
    return {(items, verdict): value for (items, verdict), value in rules.items() if not any(
        less < items and v == verdict and other[0] >= value[0]
        for (less, v), other in rules.items())}


@pytest.mark.parametrize("support", [0.05, 0.2])
def test_learned_rules(spark, support):
    rows = [(sorted({f"t{i % 3}", f"u{i % 5}", f"v{i % 7}", "every"}),
             None if i % 11 == 0 else "block" if i % 3 == 0 and i % 5 else "allow")
            for i in range(300)]
    baskets = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    rules = learn_rules(baskets, support, 0.8)
    found = {(frozenset(r.antecedent), r.verdict): (r.confidence, r.support)
             for r in rules.collect()}
    want = brute_force(rows, support, 0.8)
    assert found.keys() == want.keys()
    for key, (confidence, share) in found.items():
        assert abs(confidence - want[key][0]) < 1e-9 and abs(share - want[key][1]) < 1e-9
    judged = {tuple(r._tokens): r.learned for r in match_rules(baskets, rules).collect()}
    for tokens, _ in rows:
        fits = [(c, s, len(i), sorted(i), v) for (i, v), (c, s) in want.items() if i <= set(tokens)]
        assert judged.get(tuple(tokens)) == (max(fits)[-1] if fits else None)
