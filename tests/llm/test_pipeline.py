"""The pipeline's stages against brute force on what each predecessor kept."""

from __future__ import annotations

import random
from collections import defaultdict

import corpus_pipeline
from tradelake.llm import common, language
from tradelake.llm.common import stored, table


def grams(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stages_one_by_one(spark, folder):
    docs = table(spark, folder, "documents")
    columns = docs.columns
    quality = {r["doc_id"]: r["quality"] for r in table(spark, folder, "labels").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stored(stage(spark, docs, folder), name)
        kept[name] = docs
        rows = docs.collect()
        ids = {r["doc_id"] for r in rows}
        assert ids <= set(before)
        if name != "pack":
            assert docs.columns == columns
        if name == "language":
            assert len(ids) >= 0.99 * len(before)
        if name == "quality":
            good = [i for i in before if quality.get(i) == 1]
            bad = [i for i in before if quality.get(i) == 0]
            assert sum(i in ids for i in good) >= 0.97 * len(good)
            assert sum(i in ids for i in bad) <= 0.1 * len(bad)
        if name == "near_copies":
            assert sorted(ids) == one_of_each(before) and len(rows) == len(ids)
        if name == "mix":
            assert all(r["text"] == before[r["doc_id"]]["text"] for r in rows)
        if name == "pack":
            assert {(r["doc_id"]) for r in rows} == set(before)


UNLEARNED = (
    "Η γλώσσα είναι ένα σύστημα επικοινωνίας που χρησιμοποιούν οι άνθρωποι για να εκφράζουν τις σκέψεις τους",
    "语言是人类最重要的交际工具，人们借助语言保存和传递人类文明的成果。语言是民族的重要特征之一。",
    "Язык представляет собой сложную знаковую систему, соотносящую понятийное содержание и типовое звучание",
    "Język jest systemem znaków służącym do porozumiewania się ludzi w obrębie danej społeczności każdego dnia",
    "اللغة نسق من الإشارات والرموز، تشكل أداة من أدوات المعرفة، وتعتبر أهم وسائل التفاهم بين أفراد المجتمع",
    "言語は、狭義には、音声や文字によって人の意志・思想・感情などの情報を表現・伝達する、または理解するための約束である。",
)


def test_texts_in_unlearned_languages_go(spark):
    folder = "/root/testdata/sf0.01"
    docs = table(spark, folder, "documents")
    more = spark.createDataFrame(
        [(10**6 + i, t, None, "s", len(t or "")) for i, t in enumerate([*UNLEARNED, "12 34", None])], docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.keep_languages(spark, docs.union(more), folder).select("doc_id").collect()}
    assert max(kept) < 10**6 and len(kept) >= 0.998 * docs.count()


def one_of_each(rows):
    sets = {i: grams(r["text"]) for i, r in rows.items()}
    at = defaultdict(list)
    for i, own in sets.items():
        for g in own:
            at[g].append(i)
    shared = defaultdict(int)
    for ids in at.values():
        for a in ids:
            for b in ids:
                if a < b:
                    shared[a, b] += 1
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return sorted(i for i in root if find(i) == i)


def test_run_takes_all_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0


def made_docs(spark, n, length):
    words = [f"{c}{v}{d}" for c in "bdfgklmnprst" for v in "aeiou" for d in "lnrst"]
    texts = [" ".join(random.Random(i).choices(words[:: 1 + i % 2], k=length)) for i in range(n)]
    rows = [(i, text, f"l{i % 2}", f"s{i % 3}", len(text)) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(1)


def test_workers_get_few_bytes_at_once(spark, tmp_path, monkeypatch):
    """Whatever the session's bound on rows; a single longer text comes alone."""
    setting, kind = "spark.sql.execution.arrow.maxBytesPerBatch", type(spark.range(0))
    before, handed = spark.conf.get(setting), kind.mapInArrow

    def held(self, run, spec, *more):
        def checked(batches):
            def small():
                for batch in batches:
                    assert batch.num_rows < 2 or batch.nbytes < 200_000, f"{batch.num_rows} rows, {batch.nbytes} bytes"
                    yield batch

            return run(small())

        return handed(self, checked, spec, *more)

    monkeypatch.setattr(kind, "mapInArrow", held)
    monkeypatch.setattr(common, "BATCH_BYTES", 64 << 10, raising=False)
    docs = stored(made_docs(spark, 300, 600), "made")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) as quality")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    try:
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), name)
            assert docs.count()
    finally:
        spark.conf.set(setting, before)


def test_training_does_not_hang_on_batches(spark):
    docs, fitted = made_docs(spark, 300, 60), []
    for rows in (10_000, 70):
        with common.small_batches(spark, rows):
            fitted.append(language.fit(docs))
    assert all((getattr(fitted[0], name) == getattr(fitted[1], name)).all() for name in ("first", "last", "weights", "bias"))
