"""Mixing sources to target weights by Poisson replication.

Every source has a mean repetition rate: its target share of the mixture's bytes over
its present bytes. Each document's number of copies inverts the Poisson distribution
with that mean at a point hashed from the document's id and text, so it needs no state, no
order and no random numbers. Copies are spread over the whole output by a hash of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm import common

TERMS = 96  # of the distribution; beyond them less than 1e-30 remains at PART_MEAN
PART_MEAN = 16.0  # a larger mean is the sum of so many independent parts
SPAN = 1 << 32
BROADCAST_SOURCES = 10_000  # up to so many sources (of 1 KB each) their rates are broadcast


def _row_name() -> Column:
    """The id, the text's hash and, of rows equal in both, a number: what a row's draws and order hang on."""
    text = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text, F.col("_again"))


def _point(name: Column, seed: str, part: Column) -> Column:
    """A whole number below ``SPAN`` from the row's hash."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), name, part.cast("string"))), 1, 8), 16, 10).cast("long")


def told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_again``: null, or a number of its own for each row that repeats id and text.

    Only repeated rows are shuffled, by ranges, so a row that stands a million times is not one task's.
    """
    key = F.xxhash64("doc_id", "text")
    again = docs.select(key.alias("_key")).groupBy("_key").count().where("count > 1").select("_key")
    again = common.stored(again, "repeated-rows")
    if again.isEmpty():
        return docs.withColumn("_again", F.lit(None).cast("string"))
    keyed = docs.withColumn("_key", key)
    once = keyed.join(again, "_key", "left_anti").withColumn("_again", F.lit(None).cast("string"))
    more = keyed.join(again, "_key", "left_semi").withColumn("_any", F.rand(7))
    more = common.ranked(more, [F.col("_key"), F.col("_any")], "_again", "repeated").drop("_any")
    return once.unionByName(more.withColumn("_again", F.col("_again").cast("string"))).drop("_key")


def rates(docs: DataFrame, weights: dict[str, float] | None, epochs: float) -> DataFrame:
    """``source, parts, steps``: how many draws a source's documents take, and their cumulative steps."""
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("bytes"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        pairs = [F.lit(x) for item in weights.items() for x in item]
        weight = F.coalesce(F.create_map(*pairs)[F.col("source")] if pairs else F.lit(0.0), F.lit(0.0))
    sizes = sizes.withColumn("weight", weight)
    whole = sizes.agg(F.sum("bytes").alias("all_bytes"), F.sum("weight").alias("all_weights"))
    share = F.coalesce(F.try_divide("weight", "all_weights"), F.lit(0.0))
    mean = share * F.lit(float(epochs)) * F.col("all_bytes") / F.col("bytes")
    # one row against one row for each source
    means = sizes.join(F.broadcast(whole)).select("source", mean.alias("mean"))
    means = means.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("mean") / PART_MEAN).cast("int")))
    part = F.col("mean") / F.col("parts")
    start = F.struct(F.exp(-part).alias("p"), F.exp(-part).alias("c"), F.array(F.exp(-part)).alias("all"))

    def next_term(state: Column, k: Column) -> Column:
        p = state["p"] * part / k
        return F.struct(p.alias("p"), (state["c"] + p).alias("c"), F.concat(state["all"], F.array(state["c"] + p)).alias("all"))

    terms = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, next_term, lambda state: state["all"])
    steps = F.transform(terms, lambda c: F.ceil(c * float(SPAN)).cast("long"))
    return means.select("source", "parts", steps.alias("steps"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, seed: str = "mix") -> DataFrame:
    """``docs``, each row as often as drawn, with ``copy`` (from 1) and the hash ``mix_key`` to order by.

    ``weights`` are target shares of bytes by source (equal ones by default; a source
    that is not named gets none), ``epochs`` the mixture's size against the input's. A
    null source is a source of its own, but cannot be named. Every row is drawn by itself: a
    row's draw hangs on its id and text, of rows equal in both on a number given to
    each. Null and empty texts count one byte. Other columns stay as they are, but ``copy``
    and ``mix_key`` are replaced; an empty table gives an empty result. A very long text is
    repeated like any other, row by row.
    """
    plain = docs.drop("copy", "mix_key", "_source", "_parts", "_steps", "_again", "_key", "_name")
    known = common.stored(rates(docs, weights, epochs).toDF("_source", "_parts", "_steps"), "rates")
    # a row for each source; few of them spare the texts a shuffle by source
    few = known.count() <= BROADCAST_SOURCES
    # generated, so that the text is hashed once for all uses of the name
    rows = told_apart(plain).select("*", F.explode(F.array(_row_name())).alias("_name"))
    rows = rows.join(F.broadcast(known) if few else known, rows["source"].eqNullSafe(known["_source"]))
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("_parts")), F.lit(0),
        lambda total, part: total + _below("_steps", _point(F.col("_name"), seed, part)))
    rows = rows.withColumn("_copies", drawn).where("_copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.col("_name"), F.col("copy").cast("string")))
    return rows.select(*(F.col(f"`{c}`") for c in plain.columns), "copy", key.alias("mix_key"))


def _below(steps: str, point: Column) -> Column:
    # the one-element transform computes the point once, not for every step
    return F.get(F.transform(F.array(point), lambda p: F.size(F.filter(steps, lambda step: step <= p))), F.lit(0))


def shuffled(mixed: DataFrame) -> DataFrame:
    """The mixture in its global order, by ranges of the key."""
    order = [F.col("mix_key"), F.col("doc_id"), F.col("copy")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)


def placed(mixed: DataFrame) -> DataFrame:
    """The mixture in its global order, numbered from 0 in ``position``."""
    return common.ranked(mixed, [F.col("mix_key"), F.col("doc_id"), F.col("copy")], "position", "mixed")
