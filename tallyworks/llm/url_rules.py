"""URL filters: given rules by longest match, learned rules by FP-growth for the rest.

A url is a basket of tokens: its host labels, its path segments (digits as 0) and the names of
its query fields, all of them.  Baskets with a verdict carry it as one more item.  Tokens with
less than the least support are in no rule and leave the baskets before mining; of tokens
that the same baskets hold, one stands for all, as two of them in a rule say no more than one.
Spark's FP-growth finds the frequent combinations; those that lead to a verdict with enough
support and confidence become rules, less those that a more general rule of at least the same
confidence covers.  A rule is then written with each of the tokens that its own stand for.  An inverted index from each rule's rarest token finds the rules that
may hold for a basket; a rule holds if the basket has all its tokens.

Defined results: a null url, or one without ``://``, has empty host and path, no tokens and
the default verdict; repeated rows each get their own row; without labelled baskets no rule
is learned; an empty table gives no rows.  Only page_id and url are read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.sources.shared import settle

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
         ("org/fr/", "allow"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEARNED = T.StructType([
    T.StructField("antecedent", T.ArrayType(T.StringType())), T.StructField("verdict", T.StringType()),
    T.StructField("confidence", T.DoubleType()), T.StructField("support", T.DoubleType()),
    T.StructField("key", T.StringType())])


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(
        F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
                       ).otherwise(found)
    return found


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens, of whole host, path and query."""
    def named(kind: str, items: Column) -> Column:
        return F.transform(F.filter(items, lambda x: x != ""),
                           lambda x: F.concat(F.lit(kind), x))
    names = F.split(host, r"\.")
    steps = F.split(F.regexp_replace(path, "[0-9]+", "0"), "/")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    fields = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    return F.array_sort(F.array_distinct(F.concat(
        named("host:", names), named("path:", steps), named("query:", fields))))


def frequent_tokens(baskets: DataFrame, least: float) -> DataFrame:
    """Tokens that at least ``least`` baskets hold, and the first of those that the same hold.

    Baskets are told apart by two sums of hashes of their tokens.
    """
    counted = baskets.select(
        F.explode("tokens").alias("token"),
        *(F.xxhash64("tokens", F.lit(salt)).cast("decimal(38,0)").alias(f"_{salt}")
          for salt in (1, 2))).groupBy("token").agg(
        F.count(F.lit(1)).alias("freq"), F.sum("_1").alias("_1"), F.sum("_2").alias("_2")
    ).filter(F.col("freq") >= least)
    counted = settle(counted, "url-tokens")
    same = counted.groupBy("freq", "_1", "_2").agg(
        F.array_sort(F.collect_list("token")).alias("same"))
    return settle(same.select("freq", "same", F.col("same")[0].alias("first")), "url-frequent")


def learn_rules(baskets: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """Rules (antecedent, verdict, confidence, support, key) from baskets (tokens, verdict).

    Their number is bounded by 1 / min_support and the frequent tokens of a basket that
    different baskets hold, not by the rows.
    """
    labelled = settle(baskets.filter("verdict is not null").select("tokens", "verdict"),
                      "url-labelled")
    count = labelled.count()
    if not count:
        return baskets.sparkSession.createDataFrame([], LEARNED)
    frequent = frequent_tokens(labelled, min_support * count)
    firsts = [F.lit(row["first"]) for row in frequent.select("first").collect()]
    items = labelled.select(F.array_append(
        F.array_intersect("tokens", F.array(*firsts).cast("array<string>")),
        F.concat(F.lit("="), F.col("verdict"))).alias("items"))
    items = settle(items, "url-baskets")
    model = FPGrowth(itemsCol="items", minSupport=min_support,
                     minConfidence=min_confidence).fit(items)
    rules = model.associationRules.filter(F.col("consequent")[0].startswith("=")).filter(
        ~F.exists("antecedent", lambda x: x.startswith("="))).select(
        F.array_sort("antecedent").alias("antecedent"),
        F.substring(F.col("consequent")[0], 2, 1 << 20).alias("verdict"), "confidence", "support")
    single = model.freqItemsets.filter(F.size("items") == 1).select(
        F.col("items")[0].alias("token"), "freq")
    keys = (rules.select("antecedent", "verdict", F.explode("antecedent").alias("token"))
            .join(single, "token").groupBy("antecedent", "verdict")
            .agg(F.min(F.struct("freq", "token")).token.alias("key")))
    rules = settle(rules.join(keys, ["antecedent", "verdict"]).select(LEARNED.fieldNames()),
                   "url-mined")
    general = rules.select(F.col("antecedent").alias("_less"), F.col("verdict").alias("_verdict"),
                           F.col("confidence").alias("_confidence"), F.col("key").alias("_key"))
    covered = rules.withColumn("_token", F.explode("antecedent")).join(
        general, (F.col("_token") == F.col("_key")) & (F.col("verdict") == F.col("_verdict"))
        & (F.size("_less") < F.size("antecedent"))
        & (F.col("_confidence") >= F.col("confidence"))
        & (F.size(F.array_except("_less", "antecedent")) == 0))
    rules = rules.join(covered.select("antecedent", "verdict").distinct(),
                       ["antecedent", "verdict"], "left_anti")
    token = F.col("_token")
    parts = (rules.withColumn("_token", F.explode("antecedent"))
             .join(frequent.select(F.col("first").alias("_token"), "same"), "_token")
             .groupBy("antecedent", "verdict", "confidence", "support")
             .agg(F.collect_list("same").alias("_parts"),
                  F.max(F.when(token == F.col("key"), F.col("same"))).alias("_keys")))
    every = F.aggregate(
        "_parts", F.array(F.array().cast("array<string>")), lambda made, same: F.flatten(
            F.transform(made, lambda some: F.transform(same, lambda x: F.array_append(some, x)))))
    written = parts.withColumn("_one", F.explode(every)).select(
        F.array_sort("_one").alias("antecedent"), "verdict", "confidence", "support",
        F.array_intersect("_one", "_keys")[0].alias("key"))
    return settle(written, "url-rules")


def match_rules(baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """Verdict of each distinct basket some rule holds for: surest, then most supported."""
    hits = (baskets.select("tokens").distinct()
            .withColumn("_token", F.explode("tokens"))
            .join(rules, F.col("_token") == F.col("key"))
            .filter(F.size(F.array_except("antecedent", "tokens")) == 0))
    rank = F.struct("confidence", "support", F.size("antecedent").alias("length"),
                    "antecedent", "verdict")
    return hits.groupBy("tokens").agg(F.max(rank).alias("_best")).select(
        F.col("tokens").alias("_tokens"), F.col("_best.verdict").alias("learned"))


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES,
               min_support: float = 0.01, min_confidence: float = 0.8,
               default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every url.

    The urls that a given rule decides are the labelled baskets; what FP-growth learns from
    them judges the others.
    """
    parted = pages.select("page_id", "url", host_of(F.col("url")).alias("host"),
                          path_of(F.col("url")).alias("path"))
    given = rule_of(F.col("host"), F.col("path"), rules)
    judged = parted.withColumn("_given", given).select(
        "page_id", "host", "path", F.col("_given.rule").alias("rule"),
        F.col("_given.verdict").alias("verdict"),
        tokens_of(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    learned = match_rules(judged.filter("verdict is null"),
                          learn_rules(judged, min_support, min_confidence))
    return judged.join(learned, F.col("tokens") == F.col("_tokens"), "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", "learned", F.lit(default)).alias("verdict"))
