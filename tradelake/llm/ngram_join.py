"""N-gram Jaccard join: size-banded tiles, bitmap bound, exact sorted-array intersection.

Two texts link when their shingle sets' Jaccard similarity reaches ``percent``.

Tiles. Set sizes fall into bands so that partners lie in the same band or the
next one. Tile ``t`` holds the bands ``t - 1`` and ``t``. There a linked pair whose
smaller size is ``s`` differs in at most ``s * (100 - percent) / percent`` shingles.
Every tile is cut into cells: the hash space is split into some more parts than that
number, and a set's cell in a part is the hash of all its shingles there. By the
pigeonhole principle a linked pair then agrees in that surplus of parts at least, so
it meets in a cell that is not empty (a set with as many empty parts enters those too).
No linked pair is missed, and a passage that many texts share does not make a hot
cell unless the texts also agree in all else that falls into the part.

Cells are joined in rounds. First every set is compared with the smallest set it
shares a cell with; then cells whose members are still in different components compare
those: small cells each member with each, which is linear in the members. The sets of
larger cells meet anew by the rarest of their shingles: first with the most typical
holder, which joins most groups of copies with different edits (``star_pairs``), then
what is still apart in full (``rare_pairs``).
Pairs inside a component are never listed, so a group of k near
copies costs about k comparisons. Bit counts of the pair's bitmaps bound the overlap
from above; survivors are intersected exactly.

Sets and shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm import common
from tradelake.llm.shingles import mix, shingle_sets

CHUNK_BYTES = 1 << 20  # text that one numpy step handles
PAIR_ROWS = 64  # pairs of whole shingle sets that a worker holds at once
BITMAP_WORDS = 32  # 2,048 bits
CELL_ROWS = 1 << 19  # cells that a task sorts, about
SMALL_CELL = 8  # members; those of larger cells meet by rare shingles, which loses no link either


def band_edges(percent: int, largest: int) -> np.ndarray:
    """Smallest sizes of the bands; a partner of a size lies in its band or a neighbour."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(edges[-1] * 100 // percent + 1)
    return np.array(edges, dtype=np.int64)


def _sums(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return total[stops] - total[starts]


def cells(value: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell hashes of every set, as one array and its bounds."""
    size = np.diff(bounds)
    edges = band_edges(percent, int(size.max(initial=1)))
    band = np.searchsorted(edges, size, side="right") - 1
    owners, keys = [], []
    top = value >> np.uint64(32)
    mixed = mix(value ^ np.uint64(0x5851F42D4C957F2D))
    for role in (0, 1):  # as a member of the upper and of the lower band of a tile
        tile = band + role
        differ = (edges[np.clip(tile, 0, len(edges) - 1)] - 1) * (100 - percent) // percent
        surplus = 2 + differ * (100 - percent) // 160  # more than most sets' empty parts
        parts = np.where((size > 0) & (differ > 0), differ + surplus, 0)  # equal sets need no cell
        first = np.concatenate(([0], np.cumsum(parts)))
        owner = np.repeat(np.arange(len(size)), parts)
        if not len(owner):
            continue
        part = np.arange(first[-1]) - first[:-1][owner]
        # values are sorted by row, so a part is a run of them
        spread = np.repeat(parts, size).astype(np.uint64)
        slot = ((top * spread) >> np.uint64(32)).astype(np.int64) + np.repeat(first[:-1], size)
        used = np.repeat(parts > 0, size)
        runs = np.searchsorted(slot[used], np.arange(first[-1] + 1))
        inner = mixed[used]
        content = _sums(inner, runs[:-1], runs[1:])
        filled = runs[1:] > runs[:-1]
        empty = np.bincount(owner[~filled], minlength=len(size))
        use = filled | (empty[owner] >= surplus[owner])
        key = mix(content + mix((tile[owner] * 1_000_003 + part).astype(np.uint64)))
        owners.append(owner[use])
        keys.append(key[use])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(len(size) + 1, np.int64)
    owner, key = np.concatenate(owners), np.concatenate(keys)
    order = np.argsort(owner, kind="stable")
    return key[order], np.searchsorted(owner[order], np.arange(len(size) + 1))


def bitmaps(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A bitmap of hashed shingles for every set, one row of 64-bit words each."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    bit = (mix(value) % np.uint64(BITMAP_WORDS * 64)).astype(np.int64)
    flat = np.zeros((len(bounds) - 1) * BITMAP_WORDS * 64, dtype=np.uint8)
    flat[rows * BITMAP_WORDS * 64 + bit] = 1
    return np.packbits(flat, bitorder="little").view(np.int64)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def _class_ids(value: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One hash for each whole set."""
    size = np.diff(bounds).astype(np.uint64)
    return pa.array(mix(_sums(mix(value), bounds[:-1], bounds[1:]) + mix(size)).view(np.int64))


def _once(key: np.ndarray, ends: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of each class's first row only: equal sets would just repeat them."""
    keep = np.zeros(len(classes), dtype=bool)
    keep[np.unique(classes, return_index=True)[1]] = True
    size = np.diff(ends)
    return key[np.repeat(keep, size)], np.concatenate(([0], np.cumsum(size * keep)))


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.chunks(batches, "text", CHUNK_BYTES):
            value, bounds = shingle_sets(batch.column("text"), words)
            classes = _class_ids(value, bounds)
            size = np.diff(bounds)
            bits = np.arange(len(size) + 1) * BITMAP_WORDS
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("row_key"), pa.array(size.astype(np.int64)), classes,
                 _lists(bitmaps(value, bounds), bits)],
                names=["row_id", "row_key", "n_shingles", "class_id", "bits"])

    return run


def _cells(words: int, percent: int):
    """``class_id, cell`` rows, some hundred for a text of a few KB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.chunks(batches, "text", CHUNK_BYTES):
            value, bounds = shingle_sets(batch.column("text"), words)
            classes = _class_ids(value, bounds).to_numpy()
            key, ends = _once(*cells(value, bounds, percent), classes)
            # 48 bits take less room in shuffles; a chance match is but one more pair to compare
            cell = (key >> np.uint64(16)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(classes, np.diff(ends))), pa.array(cell)], names=["class_id", "cell"])

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.chunks(batches, "text", CHUNK_BYTES):
            value, bounds = shingle_sets(batch.column("text"), words)
            yield pa.RecordBatch.from_arrays(
                [_class_ids(value, bounds), _lists(value, bounds)], names=["class_id", "grams"])

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [(c.values.to_numpy(), c.offsets.to_numpy()) for c in (batch.column("left"), batch.column("right"))]
            (x, xs), (y, ys) = sides
            good = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                p, q = x[xs[i] : xs[i + 1]].view(np.uint64), y[ys[i] : ys[i + 1]].view(np.uint64)
                spot = np.minimum(np.searchsorted(p, q), max(len(p) - 1, 0))
                common_size = int((p[spot] == q).sum()) if len(p) else 0
                good[i] = 100 * common_size >= percent * (len(p) + len(q) - common_size)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def links_between(pairs: DataFrame, signed: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those ``pairs(a, b)`` of classes whose similarity reaches ``percent``."""
    wanted = pairs.select(F.col("a").alias("class_id")).union(pairs.select("b")).distinct()
    held = signed.join(wanted, "class_id", "left_semi").select("class_id", "n_shingles", "bits")
    held = common.stored(held.dropDuplicates(["class_id"]), "bits")
    near = pairs.join(held.toDF("a", "n_a", "bits_a"), "a").join(held.toDF("b", "n_b", "bits_b"), "b")
    outside = F.aggregate(
        F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))),
        F.lit(0), lambda total, n: total + n)
    overlap = F.least(F.col("n_a") - outside, F.col("n_b"))
    near = common.stored(
        near.where(100 * overlap >= percent * (F.col("n_a") + F.col("n_b") - overlap)).select("a", "b"), "near")
    texts = texts_of(near.select(F.col("a").alias("class_id")).union(near.select("b")).distinct(), signed, docs)
    sets = common.in_workers(texts.select("text"), _sets(words), "class_id long, grams array<long>")
    sets = common.stored(sets.dropDuplicates(["class_id"]), "sets")
    both = near.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")
    with common.small_batches(pairs.sparkSession, PAIR_ROWS):
        found = common.stored(both.mapInArrow(_verified(percent), "a long, b long"), "links")
    for step in (held, near, sets):
        common.forget(step)
    return found


def texts_of(classes: DataFrame, signed: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold a text of each of the ``classes(class_id)``, and perhaps some more."""
    rows = signed.join(classes, "class_id", "left_semi").groupBy("class_id").agg(F.min("row_id").alias("row_id"))
    return docs.join(rows.select("row_id").distinct(), docs.doc_id.eqNullSafe(F.col("row_id")), "left_semi")


def linked_classes(signed: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``(node, component)`` of all classes that link with another one."""
    members = common.stored(shared_cells(signed, docs, words, percent), "members")
    first = members.groupBy("class_id").agg(F.min("center").alias("a")).where("class_id <> a")
    links = links_between(first.select("a", F.col("class_id").alias("b")), signed, docs, words, percent)
    found = common.stored(common.components(links), "components")
    open_cells = still_open(members, found)
    small = open_cells.where("not large").select("cell", "class_id", "component")
    x, y = small.toDF("cell", "a", "of_a"), small.toDF("cell", "b", "of_b")
    pairs = x.join(y, "cell").where("a < b and of_a <> of_b").select("a", "b")
    found = with_links(found, pairs, signed, docs, words, percent)
    crowded = common.stored(open_cells.where("large").select("class_id").distinct(), "crowded")
    if crowded.isEmpty():
        return found
    held = rare_shingles(crowded, signed, docs, words, percent)
    found = with_links(found, star_pairs(with_components(held, found)), signed, docs, words, percent)
    found = with_links(found, rare_pairs(with_components(held, found), percent), signed, docs, words, percent)
    return found


def shared_cells(signed: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``cell, class_id, center`` of the cells that several classes share; the center is the smallest of them.

    Nearly all cells have one row, so nothing is gained by adding up before the shuffle, and hash tables
    of so many keys would fill an executor. Cells are shuffled once, to as many tasks as their number asks
    for whatever the session's number of partitions, and a task holds a sort of its cells, which spills.
    """
    # of both tiles; a few more than there are
    about = signed.agg(F.sum(4 + F.col("n_shingles") * 2 * (100 - percent) / percent).alias("rows")).first()["rows"]
    tasks = max(1, -(-int(about or 0) // CELL_ROWS))
    cell = common.in_workers(docs.select("text"), _cells(words, percent), "class_id long, cell long").repartition(tasks, "cell")
    of_cell = Window.partitionBy("cell")
    seen = cell.select(
        "cell", "class_id", F.min("class_id").over(of_cell).alias("center"), F.max("class_id").over(of_cell).alias("last"))
    return seen.where("center < last").select("cell", "class_id", "center").distinct()


def with_components(held: DataFrame, found: DataFrame) -> DataFrame:
    """``held`` and the ``component`` of each row's class, which is the class itself if it has no links yet."""
    placed = held.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    return common.stored(placed.withColumn("component", F.coalesce("component", "class_id")), "placed")


def still_open(members: DataFrame, found: DataFrame) -> DataFrame:
    """Rows ``cell, class_id, component, large`` of the cells that hold several components."""
    placed = with_components(members.select("cell", "class_id"), found)
    mixed = placed.groupBy("cell").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    mixed = mixed.where("low < high").select("cell", (F.col("n") > SMALL_CELL).alias("large"))
    return common.stored(placed.join(mixed, "cell"), "open")


def with_links(
    found: DataFrame, pairs: DataFrame, signed: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``found(node, component)`` after those of ``pairs(a, b)`` that link have joined their components."""
    pairs = common.stored(pairs.distinct(), "pairs")
    if pairs.isEmpty():
        return found
    more = links_between(pairs, signed, docs, words, percent)
    return common.stored(common.components(found.toDF("a", "b").union(more)), "components")


def star_pairs(held: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of each class in ``held`` with the most typical holder of each of its shingles.

    Copies with different edits are often too far from each other but near the text
    they come from, so these pairs, one for each row at most, join most of a group.
    """
    star = F.max(F.struct("typical", "class_id", "component")).alias("star")
    stars = held.groupBy("gram").agg(star).select(
        "gram", F.col("star.class_id").alias("star"), F.col("star.component").alias("of_star"))
    near = held.join(stars, "gram").where(F.col("component") != F.col("of_star"))
    return near.select(F.least("class_id", "star").alias("a"), F.greatest("class_id", "star").alias("b"))


def rare_shingles(crowded: DataFrame, signed: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``gram, class_id, n, place, typical, first``: the rarest shingles of the sets ``crowded(class_id)``.

    In an order of shingles with the rare ones first, linked sets share a shingle among
    their first few, so many that the rest alone could not reach the overlap. Shingles of
    a passage that many texts share come last and bring texts together only if they are
    nearly all there is. ``first`` marks those that the smaller set of a pair needs. ``typical`` is how often
    the set's shingles occur on average: the fewer edits a copy has, the higher.
    """
    texts = texts_of(crowded, signed, docs)
    grams = common.in_workers(texts.select("text"), _sets(words), "class_id long, grams array<long>")
    grams = common.stored(grams.dropDuplicates(["class_id"]), "crowded-sets")
    each = grams.select("class_id", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    often = each.groupBy("gram").agg(F.count("*").alias("times"), F.bit_xor(F.xxhash64("class_id")).alias("holders"))
    held = each.join(often.where("times > 1"), "gram")
    # shingles of a single set come first in the order but meet nothing; a window is one text's set
    of_class = Window.partitionBy("class_id")
    in_order = of_class.orderBy("times", "holders", "gram")
    place = F.col("n") - F.count("*").over(of_class) + F.row_number().over(in_order) - 1
    # shingles with the same holders lie together in all of these: a pair's first common one opens such a run
    opens = ~F.lag("holders").over(in_order).eqNullSafe(F.col("holders"))
    typical = F.sum("times").over(of_class) / F.col("n")
    held = held.select("*", place.alias("place"), typical.alias("typical"), opens.alias("opens")).where("opens")
    n, p = F.col("n").cast("long"), percent
    # of the smaller set, whose partner is as large at least, fewer shingles do
    as_large, as_small = (n - F.ceil(p * n / 100 - 1e-9) + 1), (n - F.ceil(2 * p * n / (100 + p) - 1e-9) + 1)
    held = held.where(F.col("place") < as_large).select(
        "gram", "class_id", "n", "place", "typical", (F.col("place") < as_small).alias("first"))
    return common.stored(held, "prefixes")


def rare_pairs(held: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` that may link, from different components, of sets that share a shingle.

    ``held`` has the columns of ``rare_shingles`` and ``component``. Sizes, and what
    follows the shingle in either set, bound the overlap: first for a set and the best
    a component has to offer, then for two sets.
    """
    p = percent
    # members of one component are not listed against each other
    parts = held.groupBy("gram", "component").agg(
        F.max("first").alias("first"), F.min(F.when(F.col("first"), F.col("n"))).alias("least"),
        F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("place")).alias("rest"))
    meet = parts.where("first").select("gram", F.col("component").alias("of_a"), "least").join(
        parts.select("gram", F.col("component").alias("of_b"), "low", "high", F.col("rest").alias("rest_b")), "gram")
    meet = meet.where("of_a <> of_b and least <= high").drop("least")
    x = held.where("first").select("gram", *(F.col(c).alias(d) for c, d in (
        ("class_id", "a"), ("component", "of_a"), ("n", "n_a"), ("place", "place_a"))))
    y = held.select("gram", *(F.col(c).alias(d) for c, d in (
        ("class_id", "b"), ("component", "of_b"), ("n", "n_b"), ("place", "place_b"))))
    rest_a, smallest = F.col("n_a") - F.col("place_a"), F.greatest("n_a", "low")
    x = x.join(meet, ["gram", "of_a"]).where((F.col("n_a") <= F.col("high")) & (100 * F.col("n_a") >= p * F.col("low")))
    x = x.where((100 + p) * F.least(rest_a, "rest_b") >= p * (F.col("n_a") + smallest))
    both = x.select("gram", "a", "n_a", "place_a", "of_b").join(y, ["gram", "of_b"])
    rest = F.least(rest_a, F.col("n_b") - F.col("place_b"))
    fits = (F.col("n_a") <= F.col("n_b")) & (100 * F.col("n_a") >= p * F.col("n_b"))
    both = both.where(fits & ((100 + p) * rest >= p * (F.col("n_a") + F.col("n_b"))))
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def ngram_join(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Takes columns ``doc_id`` and ``text``, other columns are ignored. ``n_shingles`` is
    the size of the text's shingle set, ``component_id`` the smallest doc_id that links
    reach, its own included. Null and wordless texts have 0 shingles and only
    themselves; repeated rows link with each other; a null doc_id stays null and counts
    for no minimum. Words are lower-cased A-Z between ASCII spaces. Pairs exactly at the bound
    link. An empty table gives an empty result. A very long text needs some 10 to 20 times its bytes in
    one worker (its words' hashes and sorted shingles), and its shingle set once more where it is verified.
    """
    return placed_rows(docs, words, percent).select(F.col("row_id").alias("doc_id"), "n_shingles", "component_id")


def row_key() -> Column:
    """Tells rows apart that differ in id or text."""
    return F.xxhash64("doc_id", "text")


def placed_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``row_id, row_key, n_shingles, component, component_id`` for every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    keyed = docs.select(F.col("doc_id").alias("row_id"), row_key().alias("row_key"), "text")
    signed = common.stored(
        common.in_workers(
            keyed, _signatures(words),
            "row_id long, row_key long, n_shingles long, class_id long, bits array<long>"), "signatures")
    found = linked_classes(signed.where("n_shingles > 0"), docs, words, percent)
    rows = signed.select("row_id", "row_key", "n_shingles", "class_id")
    placed = rows.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    placed = placed.withColumn("component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "class_id")))
    least = placed.where("component is not null").groupBy("component").agg(F.min("row_id").alias("least"))
    component_id = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("row_id"))
    return placed.join(least, "component", "left").select(
        "row_id", "row_key", "n_shingles", "component", component_id.alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, nulls last.

    Rows that link with nothing stay, wordless ones included. Of rows that repeat doc_id
    and text one stays if they have words.
    """
    found = common.stored(placed_rows(docs, words, percent), "placed")
    first = F.min(F.struct(F.col("row_id").isNull().alias("late"), "row_id", "row_key"))
    chosen = found.where("n_shingles > 0").groupBy("component").agg(first.alias("first")).select("first.row_key")
    stays = chosen.union(found.where("n_shingles = 0").select("row_key").distinct())
    kept = docs.withColumn("_key", row_key()).join(stays.withColumnRenamed("row_key", "_key"), "_key", "left_semi")
    again = found.where("n_shingles > 0").groupBy("row_key").count().where("count > 1").select(F.col("row_key").alias("_key"))
    again = common.stored(again, "repeated")
    if not again.isEmpty():
        once = kept.join(again, "_key", "left_semi").dropDuplicates(["_key"])
        kept = kept.join(again, "_key", "left_anti").union(once)
    return kept.select(docs.columns)
