"""Tokens anywhere in a url lead to rules, and long urls do not multiply them."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F
from tallyworks.llm.statements import URL_RULES
from tallyworks.llm.url_rules import host_of, judge_urls, learn_rules, path_of, tokens_of


def verdicts(spark, urls):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return [r.verdict for r in judge_urls(pages).sort("page_id").collect()]


def test_telling_token_far_behind(spark):
    """Labelled urls are blocked or allowed by host; what tells them apart lies deep."""
    bad, good = "http://a.net", "http://example.net/en"
    for mark in ("/a/b/c/{}/e", "/a/b/c?p=1&q=2&r=3&{}=4", "/a/b/c/d/e?p&q&r&s&t&{}"):
        labelled = [bad + mark.format("spam"), good + mark.format("fine")] * 20
        asked = ["http://x.org" + mark.format(word) for word in ("spam", "fine")]
        assert verdicts(spark, labelled + asked)[-2:] == ["block", "allow"], mark
    labelled = ["http://spam.b.c.d.net/", "http://fine.b.c.d.example.net/en/"] * 20
    assert verdicts(spark, [*labelled, "http://spam.b.c.d.org", "http://fine.b.c.d.org"])[-2:] == [
        "block", "allow"]


def test_all_tokens(spark):
    url = F.lit("http://a.b.c.d.e.f/1/22/x/y/z/x?k=1&l=2&m&n=&o=5#p")
    found = spark.range(1).select(tokens_of(url, host_of(url), path_of(url))).first()[0]
    assert found == sorted([f"host:{x}" for x in "abcdef"] + [f"path:{x}" for x in "0xyz"]
                           + [f"query:{x}" for x in "klmno"])


def test_tokens_that_come_together(spark):
    """Forty fields of one form: two to the fortieth combinations, forty rules."""
    form = sorted(f"query:f{i}" for i in range(40))
    rows = [(sorted([*form, "host:a"]), "block")] * 30 + [(["host:a", f"path:{i}"], "allow")
                                                          for i in range(70)]
    found = learn_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"),
                        0.02, 0.8).collect()
    assert sorted(r.antecedent for r in found) == [[token] for token in form]
    assert {(r.verdict, r.confidence, round(r.support, 9), r.key == r.antecedent[0])
            for r in found} == {("block", 1.0, 0.3, True)}


def test_statement_sees_whole_urls(spark):
    """Eight labels, six segments, six fields: the SQL agrees with the query and both see the end."""
    urls = []
    for i in range(40):
        word = ("spam", "fine")[i % 2]
        host = ("http://a.net", "http://example.net/en")[i % 2]
        urls += [host + f"/a/b/c/d{i}/{word}", host + f"/?p=1&q=2&r=3&s={i}&{word}x=5"]
    for word in ("spam", "fine"):
        urls += [f"http://{word}.x.org/a/b/c/d/{word}/z", f"http://q.org?p&q&r&s&{word}x=7",
                 f"http://{word}.b.c.d.e.f.g.org/x"]
    urls += [None, "", "no scheme", "http://", "http://q.org", *urls[:3]]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    sql = duckdb.connect()
    sql.register("pages", pages.toPandas())
    stated = sql.execute(URL_RULES).fetchall()
    found = [tuple(r) for r in judge_urls(pages).collect()]
    assert sorted(map(str, found)) == sorted(map(str, stated))
    judged = {urls[r[0]]: r[4] for r in found}
    assert judged["http://q.org?p&q&r&s&spamx=7"] == "block"
    assert judged["http://q.org?p&q&r&s&finex=7"] == "allow"
