"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the ``size`` smallest distinct hashes of a text's shingles. The sketch of a
whole is the merged sketch of its parts; two sketches estimate resemblance, containment
and the number of distinct shingles. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm import common

SIZE = 128
WORDS = 5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r"
_LOWER = "abcdefghijklmnopqrstuvwxyz     "


def words(text: Column) -> Column:
    """A-Z lowered, split at ASCII space; null is empty."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), " "), "")


def sketch(text: Column, size: int = SIZE, width: int = WORDS) -> Column:
    """The bottom-k sketch as a sorted array; fewer words than ``width`` are one shingle, none give an empty sketch."""
    # a one-element transform computes the words once for the many shingles
    made = F.transform(F.array(words(text)), lambda w: F.when(
        F.size(w) > 0,
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - width + 1, F.lit(1))),
                    lambda i: F.xxhash64(F.slice(w, i, width)))))
    hashes = F.coalesce(F.get(made, F.lit(0)), F.array().cast("array<bigint>"))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def merged(a: Column, b: Column, size: int = SIZE) -> Column:
    """The sketch of what the two sketched together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated Jaccard similarity; two empty sketches are alike, an empty and a filled one are not."""
    both = merged(a, b, size)
    shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def distinct_count(a: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact while the sketch is not full."""
    span = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((F.lit(size) - 1) / span)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` holds."""
    whole = distinct_count(merged(a, b, size), size)
    share = resemblance(a, b, size) * whole / distinct_count(a, size)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def written(a: Column) -> Column:
    """A sketch as text: 16 hex digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` reduced to ``doc_id, text``, with ``sketch``: any rows, null and empty texts included."""
    return docs.select("doc_id", "text", sketch(F.col("text")).alias("sketch"))


def against_next(docs: DataFrame) -> DataFrame:
    """Every row's sketch, that of its edited text, and that of the next row.

    The next row is the one that follows by descending doc_id (nulls last, equal ids by a
    hash of their rows; the first follows the last); a single row follows itself. Rows that
    repeat doc_id and text share one place. The edited text has its last half, rounded
    down, replaced by as many of the next text's first characters, or all. Returns
    ``doc_id, n_chars, edited, sketch, edited_sketch, next_sketch``; other columns are
    ignored; an empty table gives an empty result.

    Neighbours are found by ranks of ids; texts are then shuffled once, half texts once.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    base = rows.select("key", "text")  # the same for both joins, so their shuffle is one
    slim = rows.select("key", "doc_id", F.char_length("text").alias("n")).distinct()
    slim = common.stored(slim, "document-keys")
    numbered = common.ranked(slim, [F.desc_nulls_last("doc_id"), F.asc("key")], "rank", "ranked-keys")
    total = slim.count()
    if not total:
        return rows.select("doc_id", F.lit(0).alias("n_chars"), F.col("text").alias("edited"), *(
            sketch(F.col("text")).alias(n) for n in ("sketch", "edited_sketch", "next_sketch")))
    own = numbered.select(F.col("key").alias("owner"), "doc_id", F.floor(F.col("n") / 2).cast("int").alias("half"),
                          ((F.col("rank") + 1) % total).alias("rank"))
    follows = own.join(numbered.select("rank", "key"), "rank").select("key", "owner", "doc_id", "half")
    heads = base.join(follows, "key").select(
        F.col("owner").alias("key"), "doc_id", F.left(F.col("text"), F.col("half")).alias("head"), sketch(F.col("text")).alias("next_sketch"))
    if docs.count() > total:  # repeated rows share a place, so a row follows once
        heads = heads.dropDuplicates(["key"])
    length = F.char_length("text")
    edited = F.concat(F.left(F.col("text"), length - F.floor(length / 2).cast("int")), F.col("head"))
    rows = base.join(heads, "key").select("doc_id", "text", edited.alias("edited"), "next_sketch")
    return rows.select("doc_id", F.char_length("text").alias("n_chars"), "edited", sketch(F.col("text")).alias("sketch"),
                       sketch(F.col("edited")).alias("edited_sketch"), "next_sketch")
