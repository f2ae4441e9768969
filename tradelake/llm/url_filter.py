"""URL filter by association rules.

Given rules (host, path, verdict) decide the URLs they fit, the longest one first. Those
URLs label the rest: FP-growth mines combinations of URL tokens that go with a verdict,
and rules that are frequent and sure enough are kept unless a part of theirs is as sure.
A rule is listed in an inverted index under its rarest token; a URL's tokens look up
the rules, which match if all their tokens are there. The surest match decides.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm import common

#: Fixed rules: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
SUPPORT = 0.01  # of the labelled URLs
LEAST_SUPPORT = 20  # labelled URLs, however few there are
CONFIDENCE = 0.8
DEFAULT = "allow"  # where nothing matches
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as host and path; null without one."""
    order = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = None
    for own, start, _ in order:
        hit = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        fits = F.when(hit, F.lit(own + start)) if fits is None else fits.when(hit, F.lit(own + start))
    return fits if fits is not None else F.lit(None).cast("string")


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: words of the host, path parts that are not just digits, ending, query names."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), "\\?([^#]*)", 1)
    ending = F.regexp_extract(path, "\\.([A-Za-z0-9]+)$", 1)
    return F.array_distinct(F.concat(
        _named("host:", F.split(host, "[.-]")),
        _named("path:", F.filter(F.split(F.regexp_replace(path, "\\.[A-Za-z0-9]+$", ""), "/"), lambda x: ~x.rlike("^[0-9]+$"))),
        _named("ending:", F.array(ending)),
        _named("query:", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)))))


def _named(kind: str, values: Column) -> Column:
    return F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))


def token_classes(listed: DataFrame, least: float) -> DataFrame:
    """``token, item, seen, blocked`` of the tokens in at least ``least`` URLs; tokens of the very same URLs are one item.

    ``listed`` has ``url, token, verdict``. As every token listed is in one in a hundred URLs or so,
    there are no more than some hundred for each token that a URL has on average.
    """
    covers = listed.groupBy("token").agg(
        F.count("*").alias("seen"), F.count_if(F.col("verdict") == "block").alias("blocked"),
        F.bit_xor(F.xxhash64("url")).alias("x"), F.bit_xor(F.xxhash64("url", F.lit(1))).alias("y"))
    covers = covers.where(F.col("seen") >= least)
    items = covers.groupBy("seen", "blocked", "x", "y").agg(F.min("token").alias("item"))
    return common.stored(covers.join(items, ["seen", "blocked", "x", "y"]).select("token", "item", "seen", "blocked"), "token-classes")


def with_items(urls: DataFrame, classes: DataFrame) -> DataFrame:
    """``url, items`` of the URLs that have any: for each token its class."""
    listed = urls.select("url", F.explode("tokens").alias("token"))
    return listed.join(classes.select("token", "item"), "token").groupBy("url").agg(F.collect_set("item").alias("items"))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """Pruned rules ``(items, verdict, confidence, support, anchor)`` from ``labelled(url, tokens, verdict)``, and the token classes.

    A rule holds for at least ``support`` of the labelled URLs, and for ``LEAST_SUPPORT`` however few
    there are. A rule is dropped if another one with some of its tokens has the same verdict and at
    least its confidence. So tokens that always come together are mined as one item, and an item that
    is certain by itself is a rule and takes no part in combinations: neither can make any
    that would stay. Without them one long path that many URLs share would
    make a combination of every subset of its parts.
    """
    labelled_urls = labelled.count()
    least = min(1.0, max(support, LEAST_SUPPORT / max(labelled_urls, 1)))
    listed = labelled.select("url", "verdict", F.explode("tokens").alias("token"))
    classes = token_classes(listed, least * labelled_urls)
    whole_classes = classes.select("item", "seen", "blocked").distinct()
    sure = whole_classes.where("blocked = 0 or blocked = seen").select(
        F.array("item").alias("items"), F.when(F.col("blocked") > 0, "block").otherwise("allow").alias("verdict"),
        F.lit(1.0).alias("confidence"), F.col("seen").alias("support"))
    open_items = classes.where("blocked > 0 and blocked < seen")
    verdict = F.concat(F.lit("verdict:"), F.col("verdict"))
    baskets = with_items(labelled, open_items).join(labelled.select("url", verdict.alias("verdict")), "url")
    baskets = common.stored(baskets.select(F.concat("items", F.array("verdict")).alias("items")), "baskets")
    # URLs without an open item count for the support too
    least = min(1.0, least * labelled_urls / max(baskets.count(), 1))
    sets = FPGrowth(itemsCol="items", minSupport=least, minConfidence=confidence).fit(baskets).freqItemsets
    sets = common.stored(sets, "itemsets")
    is_verdict = lambda x: x.startswith("verdict:")
    split = sets.select(
        F.sort_array(F.filter("items", lambda x: ~is_verdict(x))).alias("items"),
        F.get(F.filter("items", is_verdict), F.lit(0)).alias("verdict"), "freq")
    whole = split.where("verdict is null").select("items", F.col("freq").alias("of"))
    rules = split.where("verdict is not null and size(items) > 0").join(whole, "items")
    rules = rules.withColumn("confidence", F.col("freq") / F.col("of")).where(F.col("confidence") >= confidence)
    rules = rules.select("items", F.substring_index("verdict", ":", -1).alias("verdict"), "confidence", F.col("freq").alias("support"))
    single = whole_classes.select(F.col("item").alias("token"), "seen")
    rules = common.stored(rules, "rules")
    # a part of a rule is found through each of the rule's tokens
    by_token = rules.select(F.explode("items").alias("token"), F.col("items").alias("whole"), "verdict", "confidence")
    part = rules.select(F.explode("items").alias("token"), F.col("items").alias("part"), F.col("verdict").alias("v"),
                        F.col("confidence").alias("c"))
    smaller = (F.size("part") < F.size("whole")) & (F.size(F.array_except("part", "whole")) == 0)
    beaten = by_token.join(part, "token").where(smaller & (F.col("verdict") == F.col("v")) & (F.col("c") >= F.col("confidence")))
    beaten = beaten.select(F.col("whole").alias("items"), "verdict").distinct()
    kept = rules.join(beaten, ["items", "verdict"], "left_anti").select(*sure.columns).union(sure)
    listed = kept.withColumn("token", F.explode("items")).join(single, "token")
    anchor = F.min_by("token", F.struct("seen", "token")).alias("anchor")
    return common.stored(listed.groupBy("items", "verdict", "confidence", "support").agg(anchor), "kept-rules"), classes


def judge(pages: DataFrame, rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages(page_id, url)``.

    ``mined`` is the mined rule that decided, null where a given rule or the default
    ('allow') did. Null URLs and those without '://' have an empty host and path and the
    default. Equal URLs agree, so each is judged once; of rules that tie in confidence, support and
    size a blocking one decides; other columns are ignored; an empty table gives an empty
    result. A very long URL costs time and memory in proportion to its length.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    urls = pages.select("url").distinct().select("url", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    urls = urls.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path")))
    names = F.create_map(*(F.lit(x) for own, start, verdict in rules for x in (own + start, verdict)))
    urls = common.stored(urls.withColumn("verdict", names[F.col("rule")]), "urls")
    mined, classes = mine(urls.where("rule is not null").select("url", "tokens", "verdict"), support, confidence)
    looked = with_items(urls.where("rule is null and host <> ''"), classes).withColumnRenamed("items", "own")
    looked = looked.select("url", "own", F.explode("own").alias("anchor"))
    hits = looked.join(mined.withColumnRenamed("verdict", "found"), "anchor")
    hits = hits.where(F.size(F.array_except("items", "own")) == 0)
    order = F.struct("confidence", "support", F.size("items").alias("n"), (F.col("found") == "block").alias("block"), "items")
    best = hits.groupBy("url").agg(F.max_by(F.struct("found", "items"), order).alias("best"))
    judged = urls.join(best, "url", "left").select(
        F.col("url").alias("_url"), "host", "path", "rule",
        F.coalesce("verdict", F.col("best.found"), F.lit(DEFAULT)).alias("verdict"),
        F.array_join(F.col("best.items"), " ").alias("mined"))
    return pages.select("page_id", "url").join(judged, F.col("url").eqNullSafe(F.col("_url"))).select(
        "page_id", "host", "path", "rule", "verdict", "mined")
