"""The registered queries of the operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagquality.llm import (
    bpe,
    centroids,
    decontaminate,
    fingerprint,
    langid,
    licenses,
    linededup,
    phrases,
    secrets,
    simhash,
    tokencount,
    toxicity,
    warc,
)
from tagquality.llm.common import read, scratch


def vocabulary() -> str:
    """The place of the vocabulary file; a parameter of the operators, never copied."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_captures(read(spark, sf_dir, "pages"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs, whole=True)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("th")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(read(spark, sf_dir, "documents"), scratch(spark, "ledger"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read(spark, sf_dir, "documents"), vocabulary())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_pairs(read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.document_counts(read(spark, sf_dir, "documents"), vocabulary())


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read(spark, sf_dir, "embeddings"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents")).drop("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_secrets": op4_secrets,
    "op5_bpe": op5_bpe,
    "op6_language_id": op6_language_id,
    "op7_simhash": op7_simhash,
    "op8_fingerprint": op8_fingerprint,
    "op9_toxicity": op9_toxicity,
    "op10_token_counts": op10_token_counts,
    "op11_licenses": op11_licenses,
    "op12_centroids": op12_centroids,
    "op13_phrases": op13_phrases,
}

OP3 = r"""
WITH items AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 5) AS size FROM items WHERE len(w) > 0),
parts AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS shingle
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
counts AS (SELECT item_id, count(*) AS n FROM parts GROUP BY item_id),
docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
have AS (
  SELECT DISTINCT doc_id, size, array_to_string(w[i : i + size - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM sized)))
SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_found, count(*) / n AS containment
FROM have JOIN parts USING (size, shingle) JOIN counts USING (item_id)
GROUP BY doc_id, item_id, n HAVING count(*) >= ceil(round(n * 0.8, 6))
"""


def _op12(dimensions: int = 64, count: int = 8, rounds: int = 10, scale: int = 1024) -> str:
    """Lloyd rounds, unrolled: distances of all vectors to each centroid, whole numbers throughout."""
    steps = [f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dimensions}),
v AS MATERIALIZED (SELECT r, vec_id, i, CAST(floor({scale} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT *, unnest(range(1, {dimensions} + 1)) AS i FROM kept)),
seeds AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM kept
  QUALIFY c < {count}),
c0 AS MATERIALIZED (SELECT c, i, x FROM v JOIN seeds USING (r))"""]
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT r, c, d FROM (SELECT v.r, c, sum((v.x - m.x) * (v.x - m.x))::BIGINT AS d FROM v JOIN c{k} AS m USING (i) GROUP BY v.r, c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if k < rounds:
            steps.append(f"""
n{k} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{k} JOIN v USING (r) GROUP BY c, i),
c{k + 1} AS MATERIALIZED (
  SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, x) AS x FROM c{k} LEFT JOIN n{k} USING (c, i))""")
    return ",".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
  sum(d) OVER ()::BIGINT AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN (SELECT DISTINCT r, vec_id FROM v) USING (r)
JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c) USING (c)
"""


OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs),
split AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM split, (SELECT unnest([1, 2, 3, 4]) AS m))
  GROUP BY ALL HAVING count(*) >= 30),
c AS MATERIALIZED (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) AS c
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.k], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1 : c.m], ' ')),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, s, unnest(range(1, m - s + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS s) WHERE s < m)
  GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score::BIGINT AS score
  FROM worst LEFT JOIN held USING (lang, phrase) WHERE NOT coalesce(100 * longer::HUGEINT >= 80 * a, false)
  QUALIFY rank <= 2000)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang)
"""

ORACLE: dict[str, str] = {"op3_decontamination": OP3, "op12_centroids": _op12(), "op13_phrases": OP13}
