"""The registered queries of the corpus operators and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import (
    centroids, embedding_dedup, fim, fingerprint, language, licenses, mix, ngram_join, pack, quality, sampling, shard, url_filter,
    warc)
from tradelake.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document; labels of held-out documents are not learned."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    ranker = quality.fit(docs, labels.where(sampling.remainder("doc_id", 5) != 0))
    scored = quality.score(docs.select("doc_id", "text"), ranker, ["doc_id"])
    return scored.select(
        "doc_id", (sampling.remainder("doc_id", 5) == 0).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have a Jaccard similarity of 0.9."""
    return ngram_join.ngram_join(table(spark, folder, "documents"), words=3, percent=90)


def op3_pack(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' tokens in sequences of 2,048."""
    return pack.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op4_shard(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of near-equal bytes, equal texts together."""
    placed = shard.with_slots(shard.shard(table(spark, folder, "documents"), shards=16))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op5_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and their likeness to the next document's."""
    rows = fingerprint.against_next(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint.written(F.col("sketch")).alias("fingerprint"),
        fingerprint.written(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprint.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprint.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links of all vectors whose cosine reaches 0.95, and their components."""
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"), cosine=0.95)


def op7_mix(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed so that every source has an equal share of the bytes."""
    mixed = mix.placed(mix.mix(table(spark, folder, "documents")))
    return mixed.select("doc_id", "source", "copy", "position")


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices in all documents."""
    found = licenses.labelled(licenses.scan(table(spark, folder, "documents")))
    return found.drop("notice_end")


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document; held-out documents are not learned from."""
    docs = table(spark, folder, "documents")
    network = language.fit(docs.where(sampling.remainder("doc_id", 4) != 2))
    found = language.identify(docs.select("doc_id", "text"), network, ["doc_id"])
    return found.select(
        "doc_id", (sampling.remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the URLs of all pages."""
    return url_filter.judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_fim(spark: SparkSession, folder: str) -> DataFrame:
    """Fill-in-the-middle forms of all documents, and their texts restored from them."""
    return fim.digested(table(spark, folder, "documents"))


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages archived, then read back by their index."""
    return warc.round_trip(table(spark, folder, "pages"))


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors in 8 clusters after 10 rounds."""
    return centroids.cluster(table(spark, folder, "embeddings"), k=8, rounds=10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_quality, op2_ngram_join, op3_pack, op4_shard, op5_fingerprint, op6_embedding_dedup, op7_mix,
             op8_licenses, op9_language, op10_url_filter, op11_fim, op12_warc, op13_centroids)
    return {f.__name__: f for f in found}


# A document's distinct 3-word shingles, pairs that share some, and the closure of the links.
NGRAM_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g
    FROM words),
grams AS (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM sets),
links AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (
    SELECT a AS doc_id, a AS other FROM links UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, coalesce(min(r.other), s.doc_id) AS component_id
FROM sets s LEFT JOIN reach r ON s.doc_id = r.doc_id GROUP BY s.doc_id, s.g
"""

# The cumulative Poisson steps of every source, the draw of every document, the global order of all copies.
MIX_SQL = """
WITH sizes AS (SELECT source, sum(coalesce(strlen(text), 0) + 1) AS bytes FROM documents GROUP BY source),
means AS (SELECT source, (1.0::DOUBLE / (SELECT count(*) FROM sizes)) * (SELECT sum(bytes) FROM sizes) / bytes AS mean FROM sizes),
split AS (SELECT source, greatest(1, ceil(mean / 16.0))::INT AS parts, mean / greatest(1, ceil(mean / 16.0)) AS m FROM means),
terms AS (SELECT source, parts, k, exp(-m + k * ln(m) - lgamma(k + 1)) AS p FROM split, range(0, 97) t(k)),
steps AS (SELECT source, k, ceil(sum(p) OVER (PARTITION BY source ORDER BY k) * 4294967296.0) AS step FROM terms),
draws AS (
    SELECT d.doc_id, d.source, i, ('0x' || substr(md5('mix:' || d.doc_id || ':' || md5(coalesce(d.text, '')) || ':' || i), 1, 8))::BIGINT AS point
    FROM documents d JOIN split s ON d.source IS NOT DISTINCT FROM s.source, unnest(range(1, s.parts + 1)) u(i)),
counts AS (
    SELECT w.doc_id, w.source, count(s.k) AS copies FROM draws w
    JOIN steps s ON w.source IS NOT DISTINCT FROM s.source AND s.step <= w.point GROUP BY w.doc_id, w.source),
copies AS (SELECT doc_id, source, unnest(range(1, copies + 1))::INT AS copy FROM counts)
SELECT doc_id, source, copy,
    row_number() OVER (ORDER BY md5('mix:order:' || doc_id || ':' || md5(coalesce(text, '')) || ':' || copy), doc_id, copy) - 1 AS position
FROM copies JOIN (SELECT doc_id, text FROM documents) USING (doc_id)
"""


# Cut by lists of units; the text is rebuilt from the places of the sentinels in the output.
FIM_SQL = """
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
        sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
draws AS (
    SELECT doc_id, t, u, len(u) AS n, [('0x' || substr(h, 8 * i + 1, 8))::BIGINT FOR i IN range(0, 4)] AS h FROM units),
bounds AS (
    SELECT doc_id, t, u, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
            WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM draws),
parts AS (
    SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
        array_to_string(u[b + 1:], '') AS s FROM bounds),
outputs AS (
    SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o FROM parts),
back AS (
    SELECT *, instr(o, '<P>') AS ip, instr(o, '<S>') AS i_s, instr(o, '<M>') AS im FROM outputs)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars, sha256(o) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN o WHEN 'psm' THEN substr(o, 4, i_s - 4) || substr(o, im + 3) || substr(o, i_s + 3, im - i_s - 3)
        ELSE substr(o, ip + 3, im - ip - 3) || substr(o, im + 3) || substr(o, 4, ip - 4) END) AS restored_sha256
FROM back
"""

WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS last FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
    CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM f
"""


def centroid_sql(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Lloyd rounds spelled out: components as rows, distances as sums over them."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""placed{r} AS MATERIALIZED (
    SELECT vec_id, v, min(struct_pack(distance := distance, c := c)) AS near FROM (
        SELECT vec_id, v, c, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(v, w)])::BIGINT AS distance
        FROM vectors, centroids{r}) GROUP BY vec_id, v)""")
        if r < rounds:
            steps.append(f"""moved{r} AS (
    SELECT c, list(m ORDER BY d) AS w FROM (
        SELECT c, d, (s - ((s % n) + n) % n) // n AS m FROM (
            SELECT near.c AS c, d, sum(v[d])::BIGINT AS s, count(*) AS n FROM placed{r}, range(1, {dims + 1}) t(d) GROUP BY ALL))
    GROUP BY c),
centroids{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.w, o.w) AS w FROM centroids{r} o LEFT JOIN moved{r} m ON o.c = m.c)""")
    last = f"placed{rounds}"
    return f"""WITH vectors AS MATERIALIZED (
    SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
centroids0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v AS w FROM vectors
    ORDER BY sha256('3:' || vec_id), v LIMIT {k}),
{",".join(steps)}
SELECT vec_id, near.c::INT AS cluster, near.distance AS distance, (sum(near.distance) OVER (PARTITION BY near.c))::BIGINT AS cluster_inertia,
    (sum(near.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM {last} JOIN centroids{rounds} ON near.c = centroids{rounds}.c
"""


def comparison_sql() -> dict[str, str]:
    return {"op2_ngram_join": NGRAM_SQL, "op7_mix": MIX_SQL, "op11_fim": FIM_SQL, "op12_warc": WARC_SQL,
            "op13_centroids": centroid_sql()}
