"""Hits without end, paths in common, ids that repeat or lack, and fitted models against plain code."""

from __future__ import annotations

import itertools
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tradelake.llm import common, language, licenses, mix, ngram_join, quality, sampling, shingles, url_filter


def brute_places(words, index, templates):
    """Places (template, first word of the phrase, share) as the scan defines them."""
    votes = defaultdict(float)
    for at, word in enumerate(words):
        for template, place, weight in index.get(word, ()):
            votes[template, at - place] += weight
    out = []
    for (number, start), share in votes.items():
        text, phrase = templates[number].text.split(), templates[number].phrase.split()
        first = start + text.index(phrase[0])
        if first >= 0 and words[first : first + len(phrase)] == phrase:
            out.append((number, first, round(share, 9)))
    return sorted(out)


def test_license_places_equal_brute_force(spark):
    rng = random.Random(2)
    vocabulary = sorted({w for t in licenses.TEMPLATES for w in t.text.split()}) + ["other", "words", "too"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    texts += [" ".join(x.text for x in rng.sample(licenses.TEMPLATES, 4)) for _ in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    split = docs.select("doc_id", licenses.words(F.col("text")).alias("words"))
    index = licenses.postings(licenses.rarity(split))
    for r in licenses.scan(docs).collect():
        got = sorted((p["template"], p["first"], round(p["share"], 9)) for p in r["places"])
        assert got == brute_places(texts[r["doc_id"]].split(), index, licenses.TEMPLATES)
    short = [i for i, t in enumerate(licenses.TEMPLATES) if len(t.text.split()) <= 3]
    uses = Counter(t for listed in index.values() for t, _, _ in listed)
    assert all(uses[i] == 1 for i in short)  # short templates are looked up by their rarest word


def test_a_text_of_nothing_but_hits_is_scanned_in_seconds(spark):
    text = "by license all rights reserved " * 200_000
    docs = spark.createDataFrame([(1, text), (2, "all rights reserved")], "doc_id long, text string")
    start = time.time()
    rows = {r["doc_id"]: r for r in licenses.labelled(licenses.scan(docs)).collect()}
    assert time.time() - start < 40
    assert (rows[1]["n_words"], rows[1]["n_base"], rows[1]["first_word"], rows[1]["last_word"]) == (1_000_000, 200_000, 2, 999_997)


def brute_rules(labelled, support, confidence):
    """All rules up to four tokens, without those that a part of theirs matches in confidence."""
    least = max(support * len(labelled), url_filter.LEAST_SUPPORT)
    seen, hit = Counter(), Counter()
    for own, verdict in labelled:
        for n in range(1, 5):
            for some in itertools.combinations(sorted(own), n):
                seen[some] += 1
                hit[some, verdict] += 1
    rules = {(some, v): (n / seen[some], n) for (some, v), n in hit.items() if n >= least and n / seen[some] >= confidence}
    return {
        key: value for key, value in rules.items()
        if not any(v == key[1] and set(some) < set(key[0]) and c >= value[0] for (some, v), (c, _) in rules.items())}


def test_mined_verdicts_equal_brute_force(spark):
    rng = random.Random(6)
    urls = set()
    for i in range(900):
        host = rng.choice(["net", "a.com", "b.com"])
        start = rng.choice(["es", "fr"]) if host == "net" else "in"
        parts = [p for p in ("x", "y", "z", "w") if rng.random() < (0.7 if host == "net" and p in "xy" else 0.3)]
        if "w" in parts:
            parts.append("always-with-w")
        urls.add(f"http://{host}/{start}/{'/'.join(parts)}/{i}")
    for i in range(300):
        parts = [p for p in ("x", "y", "z", "w", "always-with-w", "es", "fr", "in") if rng.random() < 0.4]
        urls.add(f"http://h.org/{'/'.join(parts)}/{i}")
    table = spark.createDataFrame(list(enumerate(sorted(urls))), "page_id long, url string")
    own = {r["url"]: set(r["t"]) for r in table.select("url", url_filter.tokens(
        F.col("url"), url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))).alias("t")).collect()}
    got = {r["url"]: r for r in table.join(url_filter.judge(table), "page_id").collect()}
    verdicts = {own_rule + start: v for own_rule, start, v in url_filter.RULES}
    labelled = [(own[u], verdicts[r["rule"]]) for u, r in got.items() if r["rule"]]
    rules = brute_rules(labelled, url_filter.SUPPORT, url_filter.CONFIDENCE)
    assert len(rules) > 5
    decided = Counter()
    for url, row in got.items():
        if not row["rule"]:
            fitting = [(c, n, len(some), v == "block") for (some, v), (c, n) in rules.items() if set(some) <= own[url]]
            want = ("block" if max(fitting)[3] else "allow") if fitting else url_filter.DEFAULT
            assert row["verdict"] == want, (url, fitting)
            decided[want] += 1
    assert len(decided) == 2


def test_urls_with_thirty_parts_in_common_are_judged_in_seconds(spark):
    path = "/".join(f"part{i}" for i in range(30))
    urls = [f"http://h{i}.{'net/es' if i % 2 else 'com/x'}/{path}/{i}" for i in range(400)]
    urls += [f"http://other{i}.org/{path}/es/{i}" for i in range(20)]
    start = time.time()
    rows = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    assert time.time() - start < 60
    assert {r["verdict"] for r in rows if r["page_id"] >= 400} == {"block"}


def test_sources_of_rows_without_ids_meet_their_weight(spark):
    rows = [(None if i % 3 == 0 else i, f"text {i} of this row" if i % 6 else "the same text", "hot" if i % 5 else "small") for i in range(12_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mix.mix(table)
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text) + 1
    rows_of = Counter(source for *_, source in rows)
    for source, n in rows_of.items():
        due = n * (sum(sizes.values()) / 2) / sizes[source]
        assert abs(counts[source] - due) < 5 * due**0.5
    nameless = {r["source"]: r["count"] for r in mixed.where("doc_id is null").groupBy("source").count().collect()}
    assert all(abs(nameless[s] / counts[s] - 1 / 3) < 0.03 for s in counts)
    assert mix.placed(mixed).select("position").distinct().count() == sum(counts.values())


def test_samples_stay_bounded_whatever_the_ids(spark):
    rows = [(7, f"text {i % 3000}", "a") for i in range(9000)] + [(i, f"t{i}", "b") for i in range(2000)] + [(None, "x", "c")] * 500
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for chosen in (table, sampling.about(table, "lang", 400)):
        counts = {r["lang"]: r["count"] for r in sampling.bounded(chosen, "lang", 400, ["doc_id", "text"]).groupBy("lang").count().collect()}
        assert all(n <= 400 * sampling.SPARE * 1.3 for n in counts.values()) and counts.get("b", 0) > 250
    language.fit(table)


def brute_identify(network, raw):
    """Mean logits over windows, filters place by place."""
    total, windows = 0.0, 0
    for at in range(0, len(raw), language.WINDOW):
        part = raw[at : at + language.WINDOW].ljust(language.WINDOW, b"\0")
        best = None
        for i in range(0, language.WINDOW - language.SPAN + 1, language.STRIDE):
            found = network.first[part[i] + 256 * part[i + 1]] + network.last[part[i + 2] + 256 * part[i + 3]]
            best = found if best is None else np.maximum(best, found)
        total, windows = total + np.maximum(best, 0) @ network.weights + network.bias, windows + 1
    odds = np.exp(total / windows - (total / windows).max())
    return network.languages[int(odds.argmax())], float(odds.max() / odds.sum())


def test_languages_equal_brute_force(spark, folder):
    docs = common.table(spark, folder, "documents")
    network = language.fit(docs)
    some = docs.orderBy(F.char_length("text")).limit(25).union(docs.where("n_chars > 3000").limit(5))
    rows = language.identify(some, network, ["doc_id", "text"]).collect()
    assert len(rows) == 30
    for r in rows:
        want, score = brute_identify(network, r["text"].encode())
        assert (r["lang_pred"] == want or not any(c.isalpha() for c in r["text"])) and abs(r["lang_score"] - score) < 1e-3


def brute_features(text):
    raw = (text or "").encode()
    pairs, kinds = Counter(), Counter()
    for a, b in zip(raw, raw[1:]):
        pairs[quality._PAIR[a * 256 + b]] += 1
        kinds[quality._CLASS[a] * quality.CLASSES + quality._CLASS[b]] += 1
    total = max(len(raw) - 1, 1)
    out = [(pairs[i] / total) ** 0.5 for i in range(quality.BUCKETS)] + [(kinds[i] / total) ** 0.5 for i in range(quality.CLASSES**2)]
    return [*out, np.log1p(len(raw)) / 10, len(pairs) / quality.BUCKETS]


def test_features_equal_brute_force(monkeypatch):
    rng = random.Random(4)
    texts = [None, "", "a", "ab", "é"] + ["".join(rng.choice("ab C1.é\n") for _ in range(rng.randrange(200))) for _ in range(40)]
    want = np.array([brute_features(t) for t in texts])
    for block in (3, 64, 1 << 18):
        monkeypatch.setattr(quality, "BLOCK", block)
        assert np.allclose(quality.features(pa.array(texts, pa.string())), want, atol=1e-6)


def test_the_ranking_agrees_with_a_plain_solver():
    """Strengths of held-out rows rank like those of a Newton solver for the same loss over all pairs."""
    rng = np.random.default_rng(5)
    truth = rng.normal(size=12)
    x = np.zeros((700, quality.WIDTH))
    x[:, :12] = rng.normal(size=(700, 12))
    good = rng.random(700) < 1 / (1 + np.exp(-3 * x[:, :12] @ truth / 12**0.5))
    ranker = quality.train(x[:500], good[:500], float((~good[:500]).mean()))
    a, b = np.flatnonzero(good[:500]), np.flatnonzero(~good[:500])
    i, j = (g.ravel() for g in np.meshgrid(a, b))
    gap = (x[i] - x[j])[:, :12]
    w = np.zeros(12)
    for _ in range(20):
        p = 1 / (1 + np.exp(gap @ w))
        w += np.linalg.solve((gap * (p * (1 - p))[:, None]).T @ gap + np.eye(12), gap.T @ p - w)
    plain, ours = x[500:, :12] @ w, x[500:] @ ranker.weights
    ranks = lambda v: v.argsort().argsort()
    assert np.corrcoef(ranks(plain), ranks(ours))[0, 1] > 0.97
    assert ((ranker.score(x[500:]) >= 0.3) == good[500:]).mean() > 0.75


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", "  "] + ["".join(rng.choice("abC  \t\nü日") for _ in range(rng.randrange(60))) for _ in range(60)] + ["x" * 999]
    column = pa.array(texts, pa.string())
    want = shingles.word_hashes(column)
    for block in (5, 16, 100):
        monkeypatch.setattr(shingles, "BLOCK", block)
        monkeypatch.setattr(shingles, "_UP", shingles._powers(shingles._ODD, block + 1))
        monkeypatch.setattr(shingles, "_DOWN", shingles._powers(shingles._INVERSE, block + 1))
        got = shingles.word_hashes(column)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_a_text_of_many_megabytes_takes_few_times_its_bytes():
    import tracemalloc

    text = pa.array(["some words of a very long text " * 300_000])
    size = text.nbytes
    for run, times in ((lambda: shingles.shingle_sets(text, 5), 40), (lambda: quality.features(text), 8)):
        tracemalloc.start()
        run()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < times * size


def test_near_copies_hand_workers_few_pairs_at_once(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with common.small_batches(spark, 64):
        assert spark.conf.get(name) == "64"
    assert spark.conf.get(name) == before and ngram_join.PAIR_ROWS <= 64


def test_every_labelled_text_counts_in_the_ranking(spark, monkeypatch):
    """Two tasks' sums over all rows give the ranker of all rows in memory, whatever their number."""
    rng = np.random.default_rng(3)
    rows = [(i, "".join(rng.choice(list("abcd" if i % 3 else "bcde"), 60)), int(i % 3 > 0)) for i in range(9000)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    monkeypatch.setattr(quality, "ROWS", 3000)
    seen = []
    learn = quality._learn
    monkeypatch.setattr(quality, "_learn", lambda total, share: (seen.append(total(quality._grams)[:, 0, 0]), learn(total, share))[1])
    ranker = quality.fit(docs, labels)
    assert seen[0].tolist() == [3000, 6000]
    x = quality.features(pa.array([t for _, t, _ in rows])).astype(np.float16).astype(float)
    plain = learn(lambda part, add=np.add: part(x, np.array([q == 1 for *_, q in rows])), 1 / 3)
    assert np.allclose(ranker.score(x), plain.score(x), atol=1e-4)


def test_every_text_counts_in_the_languages(spark):
    """Habits come from the byte pairs of all whole texts, and the network tells their languages apart."""
    rng = np.random.default_rng(8)
    rows = [(i, "".join(rng.choice(list("abc"), 300)) if i % 9 else "xyz" * 1200, "b" if i % 9 else "a") for i in range(4500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = language.fit(docs)
    for own, name in enumerate(network.languages):
        counts = np.zeros((256, 256))
        for _, text, lang in rows:
            if lang == name:
                np.add.at(counts, (np.frombuffer(text.encode()[:-1], np.uint8), np.frombuffer(text.encode()[1:], np.uint8)), 1)
        table = np.log((counts + 0.01) / (counts + 0.01).sum(axis=1, keepdims=True)).ravel()
        usual = network.habits.usual[:, own]
        assert np.allclose(usual - usual[0], table - table[0], atol=1e-4)
    found = language.identify(docs, network, ["doc_id", "lang"])
    assert found.where("lang <> lang_pred or lang_foreign").count() == 0
