"""Embedding near-duplicates by iterative quantisation.

Rotations learned by iterative quantisation, each from a start of its own, turn every
vector into balanced binary codes. Tables look up substrings of the codes: two vectors
meet in a table when its bits of their codes are equal. The number of bits follows the
number of vectors, so buckets hold some hundred, and the number of tables follows from the recall
wanted at the threshold. No two tables share a bit: bits drawn again and again from one
code would miss a pair that it places far apart in all tables together.

Buckets are shuffled with the first codes (``SKETCH`` bits) in place of the vectors. Only
vectors with a partner in the bucket within the Hamming distance that made pairs at the threshold stay
within, and not met in an earlier table that the sketch knows, are fetched and compared
by the cosine of the original vectors in double precision.

A bucket is compared inside tasks and only sums leave them: links counted for each
vector, and of each bucket's components one edge for each vector. A pair that meets in
several tables is counted in the first. Buckets beyond ``BLOCK`` rows, as a share of the vectors
tells, are dealt into blocks, every two of which meet in one task. Equal vectors are compared once, as a class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm import common

SAMPLE = 8_000  # vectors the rotation is learned from, at most about
ROUNDS = 40
RECALL = 0.995  # of pairs just at the threshold, by the tables together
BLOCK = 2_048
CROWD = 8  # a bucket holds about 2 ** CROWD vectors
SKETCH = 128  # bits of the codes that travel with a bucket's rows
MARGIN = 1.25  # on the largest Hamming distance of made pairs
COUNTED = 16  # one vector of so many counts for the sizes of buckets
CELLS = 1 << 20  # pairs met at a time
PAIRS = 1 << 14  # of them compared at a time


def rotation(sample: np.ndarray, seed: int = 5) -> np.ndarray:
    """Projection to principal axes, turned until signs lose least.

    Unit vectors are not centred: centring would part the codes of close vectors where
    one direction rules the corpus.
    """
    dims = sample.shape[1]
    _, axes = np.linalg.eigh(sample.T @ sample + 1e-9 * np.eye(dims))
    turned = sample @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    for _ in range(ROUNDS):
        u, _, vt = np.linalg.svd(np.sign(turned @ turn).T @ turned)
        turn = (u @ vt).T
    return axes @ turn


def rotations(sample: np.ndarray, codes: int) -> np.ndarray:
    """Side by side, as many rotations as ``codes``."""
    return np.hstack([rotation(sample, 5 + number) for number in range(codes)])


def _meet(dims: int, bits: int, cosine: float, seed: int = 9) -> float:
    """Chance that a pair at ``cosine`` has ``bits`` equal bits of one code.

    Drawn, because the bits of a rotation are not quite independent; no larger than if they were.
    """
    alone = (1 - math.acos(cosine) / math.pi) ** bits
    if dims == 1:
        return alone
    rng = np.random.default_rng(seed)
    x, off = rng.normal(size=(2, 1 << 15, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off -= (off * x).sum(axis=1, keepdims=True) * x
    off *= math.sqrt(max(0.0, 1 - cosine * cosine)) / np.linalg.norm(off, axis=1, keepdims=True)
    equal = (x > 0) == (cosine * x + off > 0)
    drawn = np.mean([equal[:, at : at + bits].all(axis=1).mean() for at in range(0, dims - bits + 1, bits)])
    return min(alone, float(drawn) or alone)


def substrings(dims: int, vectors: int, cosine: float) -> list[np.ndarray]:
    """The bits that each table looks up, of codes of ``dims`` bits side by side; no bit is in two tables."""
    bits = int(min(dims, max(6, round(math.log2(max(vectors, 2))) - CROWD)))
    meet = _meet(dims, bits, cosine)
    tables = max(4, math.ceil(math.log(1 - RECALL) / math.log(1 - meet))) if meet < 1 else 1
    each = dims // bits  # tables to a code
    return [number // each * dims + number % each * bits + np.arange(bits) for number in range(tables)]


def codes_of(tables: list[np.ndarray], dims: int) -> int:
    return int(tables[-1][-1]) // dims + 1


def _keys(unit: np.ndarray, project: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """The bucket of each vector in each table."""
    bits = unit @ project > 0
    return np.stack([bits[:, places] @ (1 << np.arange(len(places), dtype=np.int64)) for places in tables], axis=1)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dims)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # very large or small components do not overflow
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _sketches(unit: np.ndarray, project: np.ndarray) -> np.ndarray:
    """The first bits of the codes, packed into 64-bit words."""
    bits = np.zeros((len(unit), SKETCH), dtype=np.uint8)
    known = min(SKETCH, project.shape[1])
    bits[:, :known] = unit @ project[:, :known] > 0
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _known_keys(sketches: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """The buckets of sketches in the tables whose bits they hold."""
    bits = np.unpackbits(sketches.view(np.uint8).reshape(len(sketches), -1), axis=1, bitorder="little")
    return np.stack([bits[:, places] @ (1 << np.arange(len(places), dtype=np.int64)) for places in tables], axis=1)


def hamming_bound(sample: np.ndarray, project: np.ndarray, cosine: float, seed: int = 11) -> int:
    """Distance of sketches beyond which a pair is not fetched.

    Every vector of the sample gets partners at the threshold in random directions; the largest
    distance seen, widened by ``MARGIN``, is the bound.
    """
    if sample.shape[1] == 1 or not len(sample):
        return SKETCH
    rng = np.random.default_rng(seed)
    own, most = _sketches(sample, project), 0
    for _ in range(4):
        off = rng.normal(size=sample.shape)
        off -= (off * sample).sum(axis=1, keepdims=True) * sample
        off *= math.sqrt(max(0.0, 1 - cosine * cosine)) / np.linalg.norm(off, axis=1, keepdims=True)
        apart = np.bitwise_count(own ^ _sketches(cosine * sample + off, project)).sum(axis=1)
        most = max(most, int(apart.max()))
    return math.ceil(most * MARGIN)


def _encoded(project: np.ndarray, tables: list[np.ndarray], sketched: bool):
    """Every class once for each table, with its bucket and, if asked for, its sketch."""
    dims = len(project)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column("embedding"), dims))
            keys = _keys(unit, project, tables)
            columns, names = [batch.column("node")], ["node"]
            if sketched:
                words = _sketches(unit, project)
                columns += [pa.array(np.ascontiguousarray(words[:, at]).view(np.int64)) for at in range(words.shape[1])]
                names += [f"word{at}" for at in range(words.shape[1])]
            for number in range(len(tables)):
                bucket = pa.array(keys[:, number] * len(tables) + number)
                yield pa.RecordBatch.from_arrays([bucket, *columns], names=["bucket", *names])

    return run


def _by_run(results):
    """Calls ``results`` with whole buckets (or block pairs) of rows sorted by them."""
    names = ("bucket", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = [batch.column(c).to_numpy() for c in names]
            last = np.flatnonzero((key[0] != key[0][-1]) | (key[1] != key[1][-1]) | (key[2] != key[2][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from results(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = [batch.slice(cut)]
            elif held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in names):
                yield from results(pa.Table.from_batches(held))
                held = [batch]
            else:
                held.append(batch)
        if held:
            yield from results(pa.Table.from_batches(held))

    return run


def _runs(rows: pa.Table) -> Iterator[tuple[int, int]]:
    """First row and end of each bucket or block pair of more than one row."""
    bucket, low, high = (rows.column(c).to_numpy() for c in ("bucket", "low", "high"))
    new = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)) + 1
    edges = np.concatenate(([0], new, [len(bucket)]))
    for at in np.flatnonzero(np.diff(edges) > 1):
        yield int(edges[at]), int(edges[at + 1])


def _steps(size: int) -> Iterator[tuple[int, int]]:
    """Rows to compare at a time with all rows before their end."""
    step = max(1, CELLS // size)
    for start in range(0, size, step):
        yield start, min(size, start + step)


def _promising(tables: list[np.ndarray], bound: int):
    """Rows with a partner in their bucket whose sketch is near and that no earlier known table has."""
    known = [places for places in tables if places[-1] < SKETCH]

    def results(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        names = [name for name in rows.column_names if name.startswith("word")]
        words = np.stack([rows.column(c).to_numpy() for c in names], axis=1).view(np.uint64)
        own, low, high = (rows.column(c).to_numpy() for c in ("block", "low", "high"))
        number = rows.column("bucket").to_numpy() % len(tables)
        wanted = np.zeros(len(words), dtype=bool)
        for base, stop in _runs(rows):
            run, block = words[base:stop], own[base:stop]
            across = low[base] != high[base]
            earlier = known[: number[base]]
            keys = _known_keys(run, earlier) if earlier else None
            found = np.zeros(len(run), dtype=bool)
            for start, end in _steps(len(run)):
                apart = sum(
                    np.bitwise_count(run[start:end, at, None] ^ run[None, :end, at]).astype(np.uint16)
                    for at in range(run.shape[1]))
                x, y = np.nonzero(apart <= bound)
                x += start
                pick = y < x
                if across:
                    pick &= block[x] != block[y]
                x, y = x[pick], y[pick]
                if keys is not None and len(x):
                    fresh = np.ones(len(x), dtype=bool)
                    for table in range(keys.shape[1]):
                        fresh &= keys[x, table] != keys[y, table]
                    x, y = x[fresh], y[fresh]
                found[x] = found[y] = True
            wanted[base:stop] = found
        if wanted.any():
            kept = rows.select(["node", "bucket", "block", "low", "high"]).filter(pa.array(wanted))
            yield from kept.combine_chunks().to_batches()

    return _by_run(results)


def _joined(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels after the links x-y: the smallest row of each component."""
    while True:
        one, two = label[x], label[y]
        apart = one != two
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(one, two)[apart], np.minimum(one, two)[apart])
        while (label[label] != label).any():
            label = label[label]


def _compared(project: np.ndarray, tables: list[np.ndarray], cosine: float):
    """Links inside buckets, rows sorted by bucket and block pair; a block pair's rows come together."""
    dims = len(project)

    def results(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket, low, high, own = (rows.column(c).to_numpy() for c in ("bucket", "low", "high", "block"))
        node, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
        vectors = _unit(_matrix(rows.column("embedding").combine_chunks(), dims))
        for base, stop in _runs(rows):
            unit, block, many = vectors[base:stop], own[base:stop], copies[base:stop]
            across = low[base] != high[base]
            earlier = tables[: int(bucket[base] % len(tables))]
            keys = _keys(unit, project, earlier) if earlier else None
            count = np.zeros(len(unit), dtype=np.int64)
            label = np.arange(len(unit))
            for start, end in _steps(len(unit)):
                x, y = np.nonzero(unit[start:end] @ unit[:end].T >= cosine - 1e-9)
                x += start
                pick = y < x
                if across:  # two blocks meet only across, a block with itself only when low = high
                    pick &= block[x] != block[y]
                x, y = x[pick], y[pick]
                near = np.zeros(len(x), dtype=bool)
                for at in range(0, len(x), PAIRS):
                    part = slice(at, at + PAIRS)
                    near[part] = np.einsum("ij,ij->i", unit[x[part]], unit[y[part]]) >= cosine
                if keys is not None:
                    for table in range(keys.shape[1]):
                        near &= keys[x, table] != keys[y, table]
                x, y = x[near], y[near]
                np.add.at(count, x, many[y])
                np.add.at(count, y, many[x])
                label = _joined(label, x, y)
            linked = np.flatnonzero(count)
            if len(linked):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[base + linked]), pa.array(node[base + label[linked]]), pa.array(count[linked])],
                    names=["node", "other", "links"])

    return _by_run(results)


def _of_width(classes: DataFrame, dims: int, cosine: float) -> DataFrame:
    """``node, other, links`` over all buckets, for vectors of one width."""
    spark = classes.sparkSession
    total = classes.count()
    share = min(1.0, SAMPLE / total)
    sample = classes.where(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) < share * (1 << 30)).select("node", "embedding")
    rows = sorted(sample.collect(), key=lambda r: r["node"])
    learned = _unit(np.array([r["embedding"] for r in rows], dtype=np.float64)) if rows else np.zeros((0, dims))
    tables = substrings(dims, total, cosine)
    project = rotations(learned, max(codes_of(tables, dims), math.ceil(SKETCH / dims)))
    bound = hamming_bound(learned, project, cosine)
    vectors = classes.select("node", "embedding")
    share = vectors.where(F.pmod(F.xxhash64("node", F.lit(4)), F.lit(COUNTED)) == 0)
    sizes = share.mapInArrow(_encoded(project, tables, False), "bucket long, node long").groupBy("bucket").count()
    crowded = sizes.where(F.col("count") * COUNTED > BLOCK).select(
        "bucket", F.ceil(F.col("count") * COUNTED / BLOCK).cast("int").alias("blocks"))
    crowded = common.stored(crowded, "crowded")
    words = "".join(f", word{at} long" for at in range(SKETCH // 64))
    coded = vectors.mapInArrow(_encoded(project, tables, True), f"bucket long, node long{words}")
    coded = coded.join(crowded, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    coded = coded.withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")).cast("int"))
    coded = coded.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    coded = coded.withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with"))
    met = _together(coded.drop("blocks", "with")).mapInArrow(
        _promising(tables, bound), "node long, bucket long, block int, low int, high int")
    met = common.stored(met, "promising")
    met = met.join(classes.select("node", "embedding", "copies"), "node")
    return _together(met).mapInArrow(_compared(project, tables, cosine), "node long, other long, links long")


def _together(rows: DataFrame) -> DataFrame:
    """The rows of a bucket, or of two blocks of it, after each other in one partition."""
    key = ("bucket", "low", "high")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *key).sortWithinPartitions(*key)


def near_duplicates(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding)``.

    ``n_links`` counts the other rows whose cosine reaches the threshold, repeated rows
    included; ``component_id`` is the smallest vec_id that links reach. Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing, and
    vectors of different widths do not link. A null vec_id stays null. Other columns
    are ignored; an empty table gives an empty result. Classes of equal vectors are told
    apart by 64-bit hashes.
    """
    value = F.col("embedding")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", value).withColumn("node", F.when(usable, F.xxhash64("embedding")))
    classes = common.stored(
        rows.where("node is not null").groupBy("node").agg(
            F.count("*").alias("copies"), F.first("embedding").alias("embedding")), "classes")
    found = None
    for (width,) in classes.select(F.size("embedding")).distinct().collect():
        part = _of_width(classes.where(F.size("embedding") == width), width, cosine)
        found = part if found is None else found.union(part)
    if found is None:
        alone = F.col("vec_id")
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), alone.alias("component_id"), F.lit(True).alias("kept"))
    found = common.stored(found, "bucket-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = common.components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    placed = rows.select("vec_id", "node").join(classes.select("node", "copies"), "node", "left")
    placed = placed.join(counts, "node", "left").join(joined, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    least = placed.where("component is not null").groupBy("component").agg(F.min("vec_id").alias("least"))
    links = F.when(F.col("node").isNull(), 0).otherwise(F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
    own = F.coalesce("least", "vec_id")
    return placed.join(least, "component", "left").select(
        "vec_id", links.cast("long").alias("n_links"), own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))
