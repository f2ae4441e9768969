"""Fill-in-the-middle, archives and centroid clustering on small and awkward tables, against brute force and SQL."""

from __future__ import annotations

import gzip
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tradelake.llm import centroids, fim, warc

DOCS = "doc_id long, text string, lang string, place int, document string, rank int"
PAGES = "page_id long, url string, html string, payload string, first long"
VECTORS = "vec_id long, embedding array<float>, label int, v string, cluster int"


def awkward_texts():
    rng = random.Random(3)
    long = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(300_000))
    texts = [None, "", "a", "1", " \n", "abc def", "ünï ñandú ÀB it's 日本", "x" * 200_000, "日" * 70_000, long, "has <P> inside", "<M>",
             "a<", "<S", "< P> <<p>"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, f"word{i} and, more < words > {i}" * (1 + i % 5)) for i in range(200)]
    rows += [(7, "other text of one id"), (7, "other text of one id"), (None, "no id at all"), (None, "no id at all"), (None, None)]
    return rows


def brute_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fim_equals_brute_force(spark):
    rows = awkward_texts()
    docs = spark.createDataFrame([(*r, "en", 1, "clash", 2) for r in rows], DOCS).repartition(3)
    want = [brute_fim(*r) for r in rows]
    assert Counter(tuple(r) for r in fim.transformed(docs).collect()) == Counter(want)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    marks = Counter((*w[:5], sha(w[5]), sha(r[1])) for w, r in zip(want, rows))
    assert Counter(tuple(r) for r in fim.digested(docs).collect()) == marks


def test_fim_units_and_cuts_by_blocks(monkeypatch):
    for text in [t for _, t in awkward_texts() if t][:16]:
        raw = text.encode()
        data = np.frombuffer(raw, np.uint8)
        want = [len(text[: m.start()].encode()) for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
        for block in (7, 1 << 20) if len(raw) < 1000 else (4096,):
            monkeypatch.setattr(fim, "BLOCK_BYTES", block)
            got = np.concatenate([fim.unit_starts(data, at, at + block) for at in range(0, len(data), block)])
            assert got.tolist() == want
            n, a, b = fim.cuts(data, (5, 11, 0, 0))
            ends = [*want, len(raw)]
            assert (n, a, b) == (len(want), *sorted((ends[5 % (n + 1)], ends[11 % (n + 1)])))
        pieces = list(fim.pieces_of(data, 0, len(data)))
        assert b"".join(pieces) == raw and max(map(len, pieces)) <= fim.PIECE_BYTES


def test_fim_sorts_again_without_a_second_exchange(spark):
    docs = spark.createDataFrame(awkward_texts()[:8], "doc_id long, text string")
    lineage = fim.restored(fim.assembled(docs)).toDebugString().decode()
    assert lineage.count("ShuffledRDD") == 1


def test_fim_of_a_hot_row_spreads_over_partitions(spark):
    docs = spark.createDataFrame([(1, "one row, many times")] * 400, "doc_id long, text string").repartition(4)
    filled = fim.assembled(docs).mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(filled) == 1600 and max(filled) < 800
    assert fim.digested(docs).count() == 400


def test_empty_tables(spark):
    assert fim.digested(spark.createDataFrame([], DOCS)).count() == 0
    assert fim.transformed(spark.createDataFrame([], DOCS)).count() == 0
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0
    assert centroids.cluster(spark.createDataFrame([], VECTORS)).count() == 0


def awkward_pages():
    rng = random.Random(9)
    big = "".join(rng.choice("<p>abcdefghij é") for _ in range(3_000_000))
    copy, small = "same page " * 200, "same small page"
    rows = [(1, "http://a.example/", copy), (2, "http://b.example/x y\r\nHeader: z", copy), (9, None, copy), (9, "http://c/", copy),
            (None, "http://d/", copy), (3, "u", small), (4, "u", small), (5, "e", ""), (6, "e", None), (7, "big", big), (8, "big", big),
            (10, "q", "\r\n\r\nWARC/1.0\r\n" * 100), (11, "only é", "é" * 500), (None, "n1", "null twice " * 200), (None, "n2", "null twice " * 200)]
    rows += [(100 + i, f"http://site/{i}", f"page {i} " * rng.randrange(1, 400)) for i in range(120)]
    return rows


def brute_warc(rows):
    last = {}
    for page_id, _, html in rows:
        if page_id is not None:
            last[html or ""] = max(last.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        first = last.get(html or "") if len(raw) >= 1000 else None
        revisit = first is not None and page_id != first
        out.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return out


def test_archives_read_back_what_was_written(spark):
    rows = awkward_pages()
    pages = spark.createDataFrame([(*r, "clash", 5) for r in rows], PAGES).repartition(3)
    assert Counter(tuple(r) for r in warc.round_trip(pages).collect()) == Counter(brute_warc(rows))


def test_archives_hold_whole_records_where_the_index_says(spark, tmp_path):
    rows = awkward_pages()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    found = warc.write(pages, str(tmp_path / "w"), file_bytes=20_000).collect()
    assert len({r.file for r in found}) > 2 and len(found) == len(rows)
    htmls = Counter(h or "" for _, _, h in rows)
    for file in {r.file for r in found}:
        own = sorted((r for r in found if r.file == file), key=lambda r: r.offset)
        data = open(file, "rb").read()
        assert own[0].offset == 0 and own[-1].offset + own[-1].length == len(data)
        assert all(a.offset + a.length == b.offset for a, b in zip(own, own[1:]))
        whole = gzip.decompress(data)  # any reader of gzip members reads the archive
        for r in own:
            record = gzip.decompress(data[r.offset : r.offset + r.length])
            headers, payload = warc.parsed(record)
            assert record in whole and headers["warc-record-id"] == f"<{r.record_id}>"
            if r.record_type == "response":
                assert hashlib.sha1(payload).hexdigest() == r.payload_digest and htmls[payload.decode()]
            else:
                assert payload == b"" and headers["warc-profile"] == warc.PROFILE


def test_selected_records_are_fetched_in_few_requests(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 300) for i in range(300)], "page_id long, url string, html string")
    index = warc.write(pages.coalesce(1), str(tmp_path / "w"))
    some = index.where("page_id % 7 = 0")
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read(some.union(some.where("page_id = 7"))).collect()}
    assert got == {i: f"page {i} " * 300 for i in range(0, 300, 7)}
    entries = sorted((r.page_id, r.url, r.file, r.offset, r.length) for r in index.collect())
    assert len(list(warc.spans(entries, 1 << 30, 0))) == 1
    assert len(list(warc.spans(entries[::2], 1 << 30, 0))) == 150
    assert len(list(warc.spans(entries, 1, 0))) == 300


def test_a_broken_record_is_told(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "page " * 500)], "page_id long, url string, html string")
    index = warc.write(pages, str(tmp_path / "w"))
    with pytest.raises(Exception):
        warc.read(index.withColumn("length", index.length - 9)).collect()


def brute_nearest(vectors, points):
    distance = ((vectors[:, None, :] - points[None]) ** 2).sum(axis=2)
    return distance.argmin(axis=1), distance.min(axis=1)


@pytest.mark.parametrize(("k", "dims", "spread"), [(1, 3, 5), (8, 64, 1000), (40, 2, 1000), (300, 5, 4), (64, 1, 3)])
def test_threshold_algorithm_equals_brute_force(k, dims, spread):
    rng = np.random.default_rng(k)
    points = rng.integers(-spread, spread, (k, dims))
    vectors = np.concatenate([rng.integers(-spread, spread, (500, dims)), points, points[:1] * 3])
    number, distance = centroids.nearest(vectors, centroids.SortedLists(points.tolist()))
    want, least = brute_nearest(vectors, points)
    assert (number == want).all() and (distance == least).all()


def test_threshold_algorithm_stops_before_it_has_met_all(monkeypatch):
    rng = np.random.default_rng(1)
    points, vectors = rng.integers(0, 10**6, (500, 2)), rng.integers(0, 10**6, (200, 2))
    measured = []
    plain = np.nonzero
    monkeypatch.setattr(centroids.np, "nonzero", lambda x: measured.append(int(x.sum())) or plain(x))
    number, _ = centroids.nearest(vectors, centroids.SortedLists(points.tolist()))
    assert (number == brute_nearest(vectors, points)[0]).all() and sum(measured) < 0.3 * 500 * 200


def brute_cluster(rows, k=8, rounds=10):
    kept = [(i, [int(np.floor(1024.0 * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    kept = [(i, [min(max(x, -centroids.LIMIT), centroids.LIMIT) for x in v]) for i, v in kept]
    key = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    points = [v for _, v in sorted(kept, key=key)[:k]]
    assign = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(assign(v)[1], []).append(v)
        points = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if c in groups else p for c, p in enumerate(points)]
    placed = [(i, *assign(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in placed:
        inertia[c] += d
    marks = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return [(i, c, d, inertia[c], sum(inertia.values()), marks[c]) for i, c, d in placed]


@pytest.mark.parametrize("n", [3, 60])
def test_clusters_of_awkward_vectors_equal_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(i, [rng.gauss(i % 3, 0.3) for _ in range(64)]) for i in range(n)]
    rows += [(1, None), (2, []), (3, [0.5] * 63), (4, [0.5] * 65), (5, [None] + [0.1] * 63), (6, [float("nan")] + [0.1] * 63),
             (7, [float("inf")] + [0.1] * 63), (8, [0.0] * 64), (8, [0.0] * 64), (8, [-0.0001] * 64), (None, [1.5] * 64), (None, [-2.5] * 64)]
    rows += [(99, [3.0e38] + [0.0] * 63)] if n == 60 else []
    vectors = spark.createDataFrame([(i, v, 0, "clash", 4) for i, v in rows], VECTORS).repartition(3)
    got = [tuple(r) for r in centroids.cluster(vectors).collect()]
    assert Counter(got) == Counter(brute_cluster(rows))


def test_a_hot_vector_and_equal_vectors(spark):
    rows = [(i, [1.0] * 64) for i in range(300)] + [(1000 + i, [float(i % 5)] * 64) for i in range(100)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(tuple(r) for r in centroids.cluster(vectors).collect()) == Counter(brute_cluster(rows))
