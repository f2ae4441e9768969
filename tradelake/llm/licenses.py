"""License scan by a positional rare-token index.

Templates are word sequences of license notices with a mandatory key phrase each. Their
index lists, for each word, the templates and positions it stands at. The corpus gives
every template word its inverse document frequency; a template is looked up by its
rarest words and the rarest word of its key phrase. A file's occurrences of those words
vote for the places where a template would start; a place counts if the whole key
phrase stands there. A file's words stay in its row, so nothing is shuffled but counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RARE = 3  # words that a template is looked up by at most, besides one of its key phrase
WORDS_EACH = 2  # words of a template for each that it is looked up by


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: str  # mandatory, part of the text
    base: bool = False


#: Fixed phrases of the base labels, and notices with labels of this scan's own.
TEMPLATES = (
    Template("cc-by", "cc by", "cc by", base=True),
    Template("gpl", "general public license", "general public license", base=True),
    Template("reserved", "all rights reserved", "all rights reserved", base=True),
    Template("apache", "licensed under the apache license version", "apache license"),
    Template("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms"),
    Template("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("mit", "permission is hereby granted free of charge to any person", "permission is hereby granted free of charge"),
    Template("mpl", "mozilla public license version", "mozilla public license"),
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_APART = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """A-Z lowered, split at everything in ASCII that is no letter or digit."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, _APART), "")


def rarity(split: DataFrame, templates=TEMPLATES) -> dict[str, float]:
    """Inverse document frequency of every template word, over all of ``split(words)``."""
    known = sorted({w for t in templates for w in t.text.split()})
    counts = [F.count_if(F.array_contains("words", w)).alias(f"w{i}") for i, w in enumerate(known)]
    found = split.agg(F.count("*").alias("n"), *counts).first()
    return {w: math.log((found["n"] + 1) / (found[f"w{i}"] + 1)) for i, w in enumerate(known)}


def postings(idf: dict[str, float], templates=TEMPLATES) -> dict[str, list[tuple[int, int, float]]]:
    """The index: word to (template, position, weight) for the words each template is looked up by."""
    index: dict[str, list[tuple[int, int, float]]] = {}
    for number, template in enumerate(templates):
        listed = template.text.split()
        phrase = template.phrase.split()
        start = next(i for i in range(len(listed)) if listed[i : i + len(phrase)] == phrase)
        order = sorted(range(len(listed)), key=lambda i: (-idf[listed[i]], i))
        inside = min(range(start, start + len(phrase)), key=lambda i: (-idf[listed[i]], i))
        used = {*order[: max(1, min(RARE, len(listed) // WORDS_EACH))], inside}
        whole = sum(idf[listed[i]] for i in used) or 1.0
        for i in sorted(used):
            index.setdefault(listed[i], []).append((number, i, idf[listed[i]] / whole))
    return index


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``doc_id, n_words, places`` for every row of ``docs(doc_id, text)``.

    ``places`` are the verified ones: template number, first word of the key phrase, and
    the share (by weight) of the looked-up words that stand in place there. Null and
    wordless texts have none. Each row is scanned by itself, so repeated rows agree, and places
    that tie are all kept; other columns are ignored; an empty table gives an empty result. A text
    costs time in proportion to its words and (sorted) hits, also if it consists of nothing else,
    and memory of some 100 bytes a word in one task.
    """
    split = docs.select("doc_id", words(F.col("text")).alias("words"))
    index = postings(rarity(split, templates), templates)
    table = F.create_map(*(x for word, listed in sorted(index.items()) for x in (
        F.lit(word), F.array(*(F.struct(F.lit(t).alias("template"), F.lit(at).alias("at"), F.lit(w).alias("weight"))
                               for t, at, w in listed)))))
    spot = F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at")))
    hits = F.filter(spot, lambda hit: hit["word"].isin(sorted(index)))
    rows = split.withColumn("hits", hits)
    votes = F.flatten(F.transform("hits", lambda hit: F.transform(
        table[hit["word"]], lambda p: F.struct(
            p["template"].alias("template"), (hit["at"] - p["at"]).alias("start"), p["weight"].alias("weight")))))
    # sorted, so that the votes for one place stand together: one pass finds the places and their weights
    rows = rows.withColumn("votes", F.when(F.size("hits") > 0, F.sort_array(votes)))
    one_place = lambda a, b: a["template"].eqNullSafe(b["template"]) & a["start"].eqNullSafe(b["start"])
    most = max(len([at for listed in index.values() for t, at, _ in listed if t == number]) for number in range(len(templates)))
    vote = lambda i: F.get("votes", i)
    starts = F.filter(
        F.transform("votes", lambda v, i: F.struct(v["template"].alias("template"), v["start"].alias("start"), i.alias("at"))),
        lambda s: ~one_place(s, vote(s["at"] - 1)))
    phrases = F.array(*(F.array(*map(F.lit, t.phrase.split())) for t in templates))
    shift = F.array(*(F.lit(t.text.split().index(t.phrase.split()[0])) for t in templates))

    def stands(s: Column) -> Column:
        phrase, first = F.get(phrases, s["template"]), s["start"] + F.get(shift, s["template"])
        return (first >= 0) & (F.slice("words", F.greatest(first, F.lit(0)) + 1, F.size(phrase)) == phrase)

    verified = F.transform(F.filter(starts, stands), lambda s: F.struct(
        s["template"].alias("template"), (s["start"] + F.get(shift, s["template"])).alias("first"),
        sum((F.when(one_place(s, vote(s["at"] + i)), vote(s["at"] + i)["weight"]).otherwise(0.0) for i in range(most)),
            F.lit(0.0)).alias("share")))
    return rows.select("doc_id", F.size("words").cast("long").alias("n_words"),
                       F.coalesce(verified, F.array().cast("array<struct<template:int,first:int,share:double>>")).alias("places"))


def labelled(scanned: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``scanned`` with places of base phrases, their span, labels and the best place's share as ``score``."""
    base = [i for i, t in enumerate(templates) if t.base]
    ends = F.array(*(F.lit(len(t.phrase.split())) for t in templates))
    names = F.array(*(F.lit(t.label) for t in templates))
    own = F.filter("places", lambda p: p["template"].isin(base))
    label = lambda places: F.array_join(F.sort_array(F.array_distinct(
        F.transform(places, lambda p: F.get(names, p["template"])))), ",")
    first = F.array_min(F.transform(own, lambda p: p["first"])).cast("long")
    last = F.array_max(F.transform(own, lambda p: p["first"])).cast("long")
    score = F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)))
    span = F.array_max(F.transform("places", lambda p: p["first"] + F.get(ends, p["template"]))).cast("long")
    return scanned.select("doc_id", "n_words", F.size(own).cast("long").alias("n_base"), first.alias("first_word"),
                          last.alias("last_word"), label(own).alias("base_labels"), label(F.col("places")).alias("labels"),
                          score.alias("score"), span.alias("notice_end"))
