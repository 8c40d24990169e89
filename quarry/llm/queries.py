"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, dedup, langid, merkle, mixing, ngram, phrases, pq, quality, secrets, sharding, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark, sf_dir):
    return dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_bpe_round_trip(spark, sf_dir):
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_source_mixing(spark, sf_dir):
    return mixing.plan(_table(spark, sf_dir, "documents"))


def op7_hash_tree_sharding(spark, sf_dir):
    return sharding.shard(_table(spark, sf_dir, "documents"), sharding.Tree.of(40))


def op9_byte_gru_language_id(spark, sf_dir):
    return langid.identify(_table(spark, sf_dir, "documents"))


def op10_kneser_ney_scoring(spark, sf_dir):
    return ngram.language_model(_table(spark, sf_dir, "documents"))


def op2_kneser_ney_quality(spark, sf_dir):
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_pq_embedding_dedup(spark, sf_dir):
    return pq.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_kmeans_tree_search(spark, sf_dir):
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op6_secret_scan(spark, sf_dir):
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark, sf_dir):
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark, sf_dir):
    return merkle.without_newlines(_table(spark, sf_dir, "documents"))


def op13_warc_round_trip(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_kneser_ney_quality": op2_kneser_ney_quality,
    "op3_pq_embedding_dedup": op3_pq_embedding_dedup,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_source_mixing": op5_source_mixing,
    "op6_secret_scan": op6_secret_scan,
    "op7_hash_tree_sharding": op7_hash_tree_sharding,
    "op8_kmeans_tree_search": op8_kmeans_tree_search,
    "op9_byte_gru_language_id": op9_byte_gru_language_id,
    "op10_kneser_ney_scoring": op10_kneser_ney_scoring,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_warc_round_trip": op13_warc_round_trip,
}

#: Words as the operators take them: A-Z lower-cased, split at 0x20 and 0x09-0x0D.
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""


def _merkle_levels(name: str, leaves: str, levels: int) -> str:
    """CTEs name0 to name{levels}: nodes (g, pos, h, n) of each tree g, level by level; a tree that has its root stays as it is."""
    out = [f"{name}0 AS MATERIALIZED ({leaves})"]
    for i in range(levels):
        out.append(f"""{name}{i + 1} AS MATERIALIZED (SELECT g, pos // 3 AS pos, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h,
        CASE WHEN n > 1 THEN (n + 2) // 3 ELSE 1 END AS n FROM {name}{i} GROUP BY g, pos // 3, n)""")
    return ",\n".join(out)


def _merkle_walk(name: str, nodes: str, start: str, levels: int) -> str:
    """CTEs name0 to name{levels}: for each row the siblings so far (proof) and its version's node (own)."""
    out = [f"{name}0 AS MATERIALIZED ({start})"]
    for i in range(levels):
        out.append(f"""{name}{i + 1} AS MATERIALIZED (SELECT d.rid, d.g, d.pos // 3 AS pos, d.proof || coalesce(string_agg(v.h, '' ORDER BY v.pos) FILTER (v.pos <> d.pos), '') AS proof,
        CASE WHEN v.n > 1 THEN sha256(string_agg(CASE WHEN v.pos = d.pos THEN d.own ELSE v.h END, '' ORDER BY v.pos)) ELSE d.own END AS own
        FROM {name}{i} d JOIN {nodes}{i} v ON v.g = d.g AND v.pos // 3 = d.pos // 3 GROUP BY d.rid, d.g, d.pos, d.proof, d.own, v.n)""")
    return ",\n".join(out)


#: Levels that the SQL unrolls: enough for 177,147 rows of a source, and as many sources.
_LEVELS = 11
_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || " + _FIELD + ")"
#: Lowest bit of the crc32 of the decimal doc_id: each byte goes in before the first of its eight steps, and all bits are turned at the end.
_CRC_IS_EVEN = """list_reduce(list_prepend(4294967295::BIGINT, range(8 * length(doc_id::VARCHAR))),
    lambda c, j: xor((CASE WHEN j % 8 = 0 THEN xor(c, ascii(substr(doc_id::VARCHAR, (j // 8 + 1)::INT, 1))::BIGINT) ELSE c END) >> 1,
        CASE WHEN (CASE WHEN j % 8 = 0 THEN xor(c, ascii(substr(doc_id::VARCHAR, (j // 8 + 1)::INT, 1))::BIGINT) ELSE c END) & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)) & 1 = 1"""

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
shingles AS (
    SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s,
        len(w) < 5 AS short FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.short = b.short AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach(doc_id, r) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id),
sets AS (SELECT doc_id, list_sort(list(s)) AS k, any_value(short) AS short FROM shingles GROUP BY doc_id),
classes AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY k, short) AS text_class FROM sets)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept,
    coalesce(text_class, d.doc_id) AS text_class
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id) LEFT JOIN classes USING (doc_id)
""",
    "op3_pq_embedding_dedup": """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.r),
least AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
""",
    "op11_phrase_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spans AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) AS s(k)),
f AS MATERIALIZED (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM spans GROUP BY ALL),
total AS MATERIALIZED (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE f >= 100),
inside AS (SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM often, range(2, 5) AS s(m) WHERE m < k),
inner_phrases AS MATERIALIZED (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM inside GROUP BY ALL),
found AS MATERIALIZED (
    SELECT o.* FROM often o LEFT JOIN inner_phrases x USING (lang, phrase) WHERE o.k >= 2 AND (x.longer IS NULL OR 100 * x.longer < 100 * o.a)),
cuts AS (
    SELECT c.lang, c.phrase, c.a, j, l.a AS l, r.a AS r, t.n, (1000 * c.a::HUGEINT * t.n) // (l.a::HUGEINT * r.a::HUGEINT) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM found) c JOIN total t USING (lang)
    JOIN often l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
    JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS nth FROM cuts),
best AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE nth = 1)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM best WHERE rank <= 2000
""",
    "op12_merkle_manifest": f"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, source, {_LEAF.format("text")} AS leaf,
        CASE WHEN text IS NOT NULL AND {_CRC_IS_EVEN} THEN {_LEAF.format("replace(text, chr(10), '')")} END AS tampered FROM documents),
p AS MATERIALIZED (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY source) AS n FROM d),
{_merkle_levels("v", "SELECT g, pos, leaf AS h, n FROM p", _LEVELS)},
{_merkle_levels("u", f"SELECT 0 AS g, g AS pos, h, count(*) OVER () AS n FROM v{_LEVELS}", _LEVELS)},
{_merkle_walk("a", "v", "SELECT rid, g, pos, '' AS proof, coalesce(tampered, leaf) AS own FROM p", _LEVELS)},
{_merkle_walk("b", "u", f"SELECT rid, 0 AS g, g AS pos, proof, own FROM a{_LEVELS}", _LEVELS)}
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, sha256(b.proof) AS proof_sha256, b.own AS folded_root, b.own = r.h AS verified
FROM p JOIN b{_LEVELS} b USING (rid) JOIN v{_LEVELS} s ON s.g = p.g CROSS JOIN u{_LEVELS} r
""",
    "op13_warc_round_trip": """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
        CASE WHEN strlen(coalesce(html, '')) >= 1000 THEN max(page_id) OVER (PARTITION BY coalesce(html, '')) END AS best FROM pages)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN best <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN best <> page_id THEN best END AS refers_to
FROM p
""",
}
