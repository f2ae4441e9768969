"""The corpus operators on small tables: awkward rows, and brute force where SQL has no form."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from tradelake.llm import (
    common, embedding_dedup, fingerprint, language, licenses, mix, ngram_join, pack, quality, queries, shard, url_filter)

TOKENIZER = public_tokenizers.path(queries.TOKENIZER)
DOCS = "doc_id long, text string, lang string, source string, n_chars long, copy string, rank int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def made_text(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def awkward():
    long = made_text(1, 30_000)
    near = made_text(2, 400)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, long), (7, long + " more"), (8, near),
            (9, near.replace("alpha", "ALPHA")), (9, near), (None, near), (None, None), (10, "12 34 ..."), (11, "ünï ñandú ÀB it's"),
            (11, "ünï ñandú ÀB it's")]
    return [(i, t, "en" if i and i % 2 else None, None if i == 4 else f"s{(i or 0) % 3}", None, "clash", 7) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute_components(rows, width, percent):
    """Smallest id reachable by links, by comparing all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[find(i)].append(doc_id)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return [(d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def by_text(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_ngram_join_equals_brute_force(spark, width, percent):
    rng = random.Random(width)
    rows = [(r[0], r[1]) for r in awkward()]
    for base in range(12):  # chains of ever more different copies
        words = made_text(base + 50, rng.choice([7, 12, 40, 150, 300])).split()
        for _ in range(6):
            rows.append((100 + len(rows), " ".join(words)))
            for _ in range(rng.randrange(1, 3)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [tuple(r) for r in ngram_join.ngram_join(docs, width, percent).collect()]
    assert by_text(got) == by_text(brute_components(rows, width, percent))


def test_ngram_join_of_texts_with_a_common_passage(spark, monkeypatch):
    """Passages of all lengths against the rest, some texts near copies; small and large cells agree with brute force."""
    rng = random.Random(5)
    passage, rows = made_text(70, 90).split(), []
    for i in range(150):
        own = made_text(500 + i, rng.choice([4, 9, 20, 30, 60])).split()
        rows.append((i, " ".join(own[: len(own) // 2] + passage + own[len(own) // 2 :])))
        if i % 5 == 0:
            rows.append((1000 + i, rows[-1][1].replace(own[0], "changed", 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = by_text(brute_components(rows, 5, 80))
    for most in (8, 1):
        monkeypatch.setattr(ngram_join, "SMALL_CELL", most)
        assert by_text(tuple(r) for r in ngram_join.ngram_join(docs, 5, 80).collect()) == want


def test_ngram_join_of_a_dense_group_emits_few_pairs(spark):
    words = made_text(3, 120).split()
    rows = [(i, " ".join(words[:60] + [f"x{i}"] + words[60:])) for i in range(300)]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert {r["component_id"] for r in got} == {0}


def test_keep_one_keeps_one_of_each_group_and_all_else(spark, docs, empty):
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, 6, 8, 10, 11, None], key=str)
    assert ngram_join.keep_one(empty).count() == 0


def test_components_of_chains_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 80), (80, 100), (7, 7)]
    found = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 80: 80, 90: 80, 100: 80}


def test_pack_is_a_round_trip(spark, docs, empty):
    from tokenizers import Tokenizer

    rows = pack.pack(docs, TOKENIZER).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = []
    for doc_id, text, *_ in awkward():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], dtype="<u4")
            want.append((doc_id, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert by_text(tuple(r)[:5] for r in rows) == by_text(want)
    ends = defaultdict(list)
    for r in rows:
        ends[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in ends.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(ends) <= -(-sum(r["length"] for r in rows) // 2048) + 1
    assert pack.pack(empty, TOKENIZER).count() == 0


@pytest.mark.parametrize("word", ["it's", "O'Reilly's", "x²", "½", "A''s", "1234abc", "héÉ×÷", "a’b", "中文", "<|endoftext|>", "a\x1cb", "éx"])
def test_token_bytes_equal_the_tokenizer(word):
    ids = pack.word_ids(TOKENIZER)
    want = [*ids.tokenizer.encode(f"see {word}, {word}", add_special_tokens=False).ids, 0]
    assert pack.token_bytes(f"see {word}, {word}", ids) == np.array(want, dtype="<u4").tobytes()


@pytest.mark.parametrize("seed", range(4))
def test_plans_fill_sequences_almost(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(6.3, 1.1, 20_000).astype(int), 1, 2048)
    if seed == 3:
        lengths[:7000] = 700
    sizes, counts = np.unique(lengths, return_counts=True)
    runs = pack.plan(sorted(zip(sizes.tolist(), counts.tolist()), reverse=True), 2048)
    place = np.full(len(lengths), -1)
    for rank, first, n in runs:
        assert (place[rank : rank + n] == -1).all()
        place[rank : rank + n] = np.arange(first, first + n)
    fill = np.bincount(place, weights=np.sort(lengths)[::-1])
    assert place.min() >= 0 and fill.max() <= 2048
    if seed < 3:
        assert len(fill) <= 1.01 * lengths.sum() / 2048


def test_shards_are_near_equal_and_keep_groups(spark, docs, empty):
    more = spark.createDataFrame([(1000 + i, made_text(i, 1 + i % 90)) for i in range(900)], "doc_id long, text string")
    rows = shard.with_slots(shard.shard(docs.select("doc_id", "text").union(more), 4, cell=64)).collect()
    assert len(rows) == len(awkward()) + 900
    places, total = defaultdict(set), defaultdict(int)
    slots = defaultdict(list)
    for r in rows:
        places[r["item"]].add(r["shard"])
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(p) == 1 for p in places.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len(t.encode()) for _, t, *_ in awkward() if t)
    assert max(total.values()) <= max(largest + 1, 1.02 * sum(total.values()) / 4)
    assert shard.with_slots(shard.shard(empty)).count() == 0


def test_differencing_tracks_every_place():
    rng = random.Random(4)
    partials = [sorted(rng.randrange(100) for _ in range(5)) for _ in range(60)]
    sums, went = shard.difference(partials)
    total = [0] * 5
    for sizes, places in zip(partials, went):
        for p, size in zip(places, sizes):
            total[p] += size
    assert total == sums and max(sums) - min(sums) <= 5


def test_fingerprints_of_edited_and_next(spark, docs, empty):
    got = fingerprint.against_next(docs).collect()
    assert len(got) == len(awkward()) and fingerprint.against_next(empty).count() == 0
    plain = [(i, made_text(i, 80)) for i in range(30)]
    table = spark.createDataFrame(plain, "doc_id long, text string")
    for r in fingerprint.against_next(table).collect():
        own, after = plain[r["doc_id"]][1], plain[(r["doc_id"] - 1) % 30][1]
        half = len(own) // 2
        assert r["edited"] == own[: len(own) - half] + after[:half]
        assert len(r["sketch"]) == min(fingerprint.SIZE, len(shingles(own, 5)))


def test_sketches_estimate_and_merge(spark):
    a, b = made_text(1, 3000).split(), made_text(2, 3000).split()
    table = spark.createDataFrame([(" ".join(a), " ".join(a[:2000] + b[:1000]), "")], "a string, b string, c string")
    s = {c: fingerprint.sketch(table[c], 512) for c in "abc"}
    row = table.select(
        fingerprint.resemblance(s["a"], s["b"], 512).alias("near"), fingerprint.containment(s["b"], s["a"], 512).alias("held"),
        fingerprint.distinct_count(s["a"], 512).alias("n"), fingerprint.resemblance(s["c"], s["c"], 512).alias("none"),
        fingerprint.resemblance(s["a"], s["c"], 512).alias("apart")).first()
    x, y = shingles(" ".join(a), 5), shingles(" ".join(a[:2000] + b[:1000]), 5)
    assert abs(row["near"] - len(x & y) / len(x | y)) < 0.08
    assert abs(row["held"] - len(x & y) / len(y)) < 0.12
    assert abs(row["n"] / len(x) - 1) < 0.15
    assert (row["none"], row["apart"]) == (1.0, 0.0)


def test_embedding_links_reach_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 32))
    vectors = [c + rng.normal(size=32) * s for c in centres for s in (0.05, 0.1, 0.15, 0.2)]
    vectors += [vectors[0]] * 3
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 32, [None] * 32, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [1.0] * 8]
    rows += [(1000 + i, v) for i, v in enumerate(odd)] + [(None, [1.0] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(table, 0.95).collect()}
    unit = np.array(vectors, dtype=np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    found = sum(got[i]["n_links"] for i in range(len(vectors)))
    assert 0.9 * near.sum() <= found <= near.sum()
    assert all(got[i]["n_links"] <= near[i] for i in range(len(vectors)))
    assert all(got[1000 + i]["n_links"] == 0 and got[1000 + i]["kept"] for i in range(6))
    assert got[1006]["n_links"] == 1
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


@pytest.mark.parametrize("vectors", [2_000, 1_000_000, 100_000_000])
def test_embedding_tables_reach_the_recall_at_the_threshold(vectors):
    rng = np.random.default_rng(8)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    tables = embedding_dedup.substrings(64, vectors, 0.95)
    project = embedding_dedup.rotations(unit(rng.normal(size=(2000, 64))), embedding_dedup.codes_of(tables, 64))
    assert len(np.unique(np.concatenate(tables))) == sum(len(places) for places in tables)
    x = unit(rng.normal(size=(4000, 64)))
    off = rng.normal(size=x.shape)
    off = unit(off - (off * x).sum(axis=1, keepdims=True) * x)
    y = 0.95 * x + (1 - 0.95**2) ** 0.5 * off
    same = embedding_dedup._keys(x, project, tables) == embedding_dedup._keys(y, project, tables)
    assert same.any(axis=1).mean() >= 0.99


def test_sketches_keep_pairs_at_the_threshold():
    rng = np.random.default_rng(18)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    # directions even, and one direction that rules
    for lean in (0.0, 1.0):
        make = lambda n: unit(rng.normal(size=(n, 64)) + lean)  # noqa: E731, B023
        learned, x = make(2000), make(20_000)
        project = embedding_dedup.rotations(learned, 2)
        bound = embedding_dedup.hamming_bound(learned, project, 0.95)
        off = rng.normal(size=x.shape)
        off = unit(off - (off * x).sum(axis=1, keepdims=True) * x)
        y = 0.95 * x + (1 - 0.95**2) ** 0.5 * off
        bits = lambda v: embedding_dedup._sketches(v, project)  # noqa: E731, B023
        apart = np.bitwise_count(bits(x) ^ bits(y)).sum(axis=1)
        plain = ((x @ project > 0) != (y @ project > 0)).sum(axis=1)
        assert (apart == plain).all() and (apart <= bound).mean() >= 0.9999
        others = np.bitwise_count(bits(x) ^ np.roll(bits(x), 1, axis=0)).sum(axis=1)
        assert lean or (others <= bound).mean() < 0.001
        tables = embedding_dedup.substrings(64, 2000, 0.95)
        known = [places for places in tables if places[-1] < embedding_dedup.SKETCH]
        assert (embedding_dedup._known_keys(bits(x), known) == embedding_dedup._keys(x, project, known)).all()


def test_blocks_of_a_hot_bucket_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "CELLS", 100)
    monkeypatch.setattr(embedding_dedup, "PAIRS", 7)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in 1 + rng.normal(size=16) * 0.01]) for i in range(90)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r["component_id"] for r in got} == {0}
    assert np.mean([r["n_links"] for r in got]) >= 0.95 * 89


def test_license_scan_equals_brute_force(spark, docs, empty):
    import re

    texts = ["Licensed under CC BY-NC 4.0. All rights reserved. (all RIGHTS reserved)", "cc. by cc by", "rights reserved all",
             "GNU General Public License, version 3", None, "", "ccby", "licensed under the Apache License, Version 2.0"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(r[0], r[1]) for r in awkward()]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = licenses.labelled(licenses.scan(table)).collect()
    phrases = {t.label: t.phrase.split() for t in licenses.TEMPLATES if t.base}
    want = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        at = [(i, k) for k, p in phrases.items() for i in range(len(words)) if words[i : i + len(p)] == p]
        want.append((doc_id, len(words), len(at), min(at)[0] if at else None, max(at)[0] if at else None,
                     ",".join(sorted({k for _, k in at}))))
    assert by_text(tuple(r)[:6] for r in got) == by_text(want)
    labels = {r["doc_id"]: r["labels"] for r in got if r["n_words"] and r["doc_id"] in (0, 3, 7) and r["n_words"] < 20}
    assert labels[3] == "gpl,gpl-3" and labels[0] == "cc-by,cc-by-nc,reserved" and labels[7] == "apache"
    assert all(0 <= r["score"] <= 1 for r in got)
    assert licenses.labelled(licenses.scan(empty)).count() == 0


def test_url_rules_and_mined_verdicts(spark):
    urls = [None, "no scheme", "http://", "http://COM/x", "https://a.Example.com/en/1?x=1#y", "http://www.example.com/en/1",
            "http://www.example.com/fr/1", "http://x.net/es/2", "http://x.net/de/2", "http://com", "ftp://evil.org/es/3://q", ""]
    urls += [f"http://h{i}.net/{'es' if i % 2 else 'fr'}/{i}?bad=1" for i in range(60)] + [f"http://h{i}.com/{i}" for i in range(60)]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' as host", "'y' as rule")
    got = {r["page_id"]: r for r in url_filter.judge(table).collect()}
    rule = [got[i]["rule"] for i in range(12)]
    assert rule == [None, None, None, "com/", "example.com/en/", "www.example.com/en/", "com/", "net/es/", None, None, None, None]
    assert [got[i]["verdict"] for i in (4, 5, 6, 7)] == ["block", "allow", "allow", "block"]
    assert (got[4]["host"], got[4]["path"], got[0]["host"], got[2]["path"]) == ("a.example.com", "/en/1", "", "")
    assert got[10]["verdict"] == "block" and got[10]["mined"]  # an 'es' path, as the blocked ones
    assert got[0]["verdict"] == "allow" and len(got) == len(urls)
    assert url_filter.judge(table.limit(0)).count() == 0


def test_mixture_meets_its_weights(spark, docs, empty):
    rows = [(i, "x" * 99, "big" if i % 10 else "small") for i in range(20_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    counts = {r["source"]: r["count"] for r in mix.mix(table, {"big": 1.0, "small": 3.0}, epochs=2.0).groupBy("source").count().collect()}
    assert abs(counts["big"] / 10_000 - 1) < 0.05 and abs(counts["small"] / 30_000 - 1) < 0.05
    placed = mix.placed(mix.mix(docs, epochs=30.0))
    assert sorted(r["position"] for r in placed.collect()) == list(range(placed.count()))
    assert set(docs.columns) <= set(placed.columns) and placed.where("source is null").count() > 0
    assert mix.placed(mix.mix(empty)).count() == 0
    assert mix.mix(docs, {}).count() == 0


def test_language_on_awkward_rows(spark, docs, empty, folder):
    known = common.table(spark, folder, "documents")
    network = language.fit(known)
    got = language.identify(docs, network, ["doc_id", "text"]).collect()
    assert len(got) == len(awkward())
    for r in got:
        has = bool(r["text"]) and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not has) and 0 <= r["lang_score"] <= 1
    assert language.identify(empty, network, ["doc_id"]).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs, language.fit(empty), ["doc_id"]).collect()} == {"und"}


def test_folded_filters_equal_the_network(spark, folder):
    rows = common.table(spark, folder, "documents").select("text", "lang").limit(60).collect()
    network = language.train([r["text"] for r in rows], [r["lang"] for r in rows])
    window = np.random.default_rng(1).integers(0, 256, (1, language.WINDOW)).astype(np.uint8)
    pairs = window.view("<u2")[0]
    best = np.max([network.first[a] + network.last[b] for a, b in zip(pairs, pairs[1:])], axis=0)
    want = np.maximum(best, 0) @ network.weights + network.bias
    assert np.allclose(network.logits(window)[0], want, atol=1e-4)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in common.table(spark, folder, "labels").collect()}
    held = [r for r in queries.op1_quality(spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) >= 0.95
    langs = {r["doc_id"]: r["lang"] for r in common.table(spark, folder, "documents").select("doc_id", "lang").collect()}
    held = [r for r in queries.op9_language(spark, folder).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) >= 0.97


def test_quality_on_awkward_rows(spark, docs, empty):
    labels = spark.createDataFrame([(4, 1), (10, 0), (8, 1), (11, None), (None, 1), (4, 1)], "doc_id long, quality int")
    ranker = quality.fit(docs, labels)
    got = quality.score(docs, ranker, ["doc_id"]).collect()
    assert len(got) == len(awkward()) and all(0 <= r["quality_score"] <= 1 for r in got)
    assert quality.score(empty, ranker, ["doc_id"]).count() == 0
    blind = quality.fit(docs, labels.limit(0))
    assert {r["quality_score"] for r in quality.score(docs, blind, ["doc_id"]).collect()} == {0.5}


@pytest.mark.parametrize("name", list(queries.comparison_sql()))
def test_query_equals_sql(spark, folder, name):
    assert compare(queries.queries()[name](spark, folder), connect(folder), queries.comparison_sql()[name]) is None


def test_sharded_texts_keep_their_checksums(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in common.table(spark, folder, "documents").collect()}
    rows = queries.op4_shard(spark, folder).collect()
    assert len(rows) == len(texts)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)
    edited = queries.op5_fingerprint(spark, folder).collect()
    order = sorted(texts, reverse=True)
    follow = dict(zip(order, [*order[1:], order[0]]))
    for r in edited:
        own, after = texts[r["doc_id"]], texts[follow[r["doc_id"]]]
        half = len(own) // 2
        assert r["edited_sha256"] == hashlib.sha256((own[: len(own) - half] + after[:half]).encode()).hexdigest()


def test_cells_are_dealt_by_their_number(spark, monkeypatch):
    most, stored = {}, common.stored

    def noted(df, label):
        found = stored(df, label)
        if label == "members":
            most["files"], most["all"] = len(found.inputFiles()), found.count()
            most["rows"] = max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        return found

    monkeypatch.setattr(common, "stored", noted)
    monkeypatch.setattr(ngram_join, "CELL_ROWS", 500, raising=False)
    texts = [" ".join(f"w{i}x{j}" for j in range(120)) for i in range(60)]
    rows = [(2 * i + k, text + " end" * k) for i, text in enumerate(texts) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_join(docs, 5, 80).collect()}
    assert got == {i: i - i % 2 for i in got} and len(got) == 120
    # whatever spark.sql.shuffle.partitions says (4 here), tasks have some 500 cells each
    assert most["files"] > 8 and most["rows"] < most["all"] / 6
