"""Registered queries of the training-data operators and their SQL.

Each query reads its whole table and derives the columns of its contract from
the operator's own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelson.llm import (
    embed_dedup,
    fingerprint,
    html_extract,
    language,
    minhash_dedup,
    mix_sources,
    pack,
    phrases,
    quality,
    quote_links,
    toxicity,
    url_rules,
    whitening,
)
from keelson.llm.common import read


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources.mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source")


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read(spark, sf_dir, "documents"), shingle=4).select(
        "doc_id", "n_shingles", "component_id", "kept")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_links.link_quotes(read(spark, sf_dir, "conversations"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(read(spark, sf_dir, "documents"))


# The contract's rules: (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(read(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op10_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_html_extract": op2_html_extract,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_pack": op4_pack,
    "op5_quality": op5_quality,
    "op6_quote_links": op6_quote_links,
    "op7_language": op7_language,
    "op8_fingerprint": op8_fingerprint,
    "op9_url_rules": op9_url_rules,
    "op10_embed_dedup": op10_embed_dedup,
    "op11_toxicity": op11_toxicity,
    "op12_phrases": op12_phrases,
    "op13_whitening": op13_whitening,
}

_URL_PARTS = r"""
parts AS (SELECT page_id, url,
  CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id,
  translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS rid FROM parts)
"""

ORACLE: dict[str, str] = {
    "op9_url_rules": f"""
WITH rules(rhost, rpath, verdict) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
{_URL_PARTS},
hits AS (SELECT s.rid, r.rhost || r.rpath AS rule, r.verdict,
  row_number() OVER (PARTITION BY s.rid ORDER BY length(r.rhost || r.rpath) DESC, length(r.rhost) DESC) AS k
  FROM split s JOIN rules r ON (s.host = r.rhost OR ends_with(s.host, '.' || r.rhost)) AND starts_with(s.path, r.rpath))
SELECT s.page_id, coalesce(s.host, '') AS host, coalesce(s.path, '') AS path, h.rule, coalesce(h.verdict, 'allow') AS verdict
FROM split s LEFT JOIN hits h ON s.rid = h.rid AND h.k = 1""",
    "op10_embed_dedup": """
WITH RECURSIVE vecs AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
ok AS (SELECT * FROM vecs WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
  AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id))::BIGINT AS component_id,
  least(e.vec_id, coalesce(l.b, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN degree d ON e.vec_id = d.a LEFT JOIN lowest l ON e.vec_id = l.a""",
    "op12_phrases": """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM lists GROUP BY lang),
grams AS (SELECT lang, w, len(w) AS size, unnest(range(1, len(w) + 1)) AS i FROM lists),
counts AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS a
  FROM grams, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= size GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2),
cuts AS (SELECT lang, k, phrase, a, c, array_to_string(w[1:c], ' ') AS f, array_to_string(w[c + 1:], ' ') AS g
  FROM cand, (SELECT unnest([1, 2, 3, 4]) AS c) WHERE c < k),
scored AS (SELECT u.*, x.a AS l, y.a AS r, t.n, (1000 * u.a * t.n) // (x.a * y.a) AS score
  FROM cuts u JOIN counts x ON x.lang = u.lang AND x.phrase = u.f JOIN counts y ON y.lang = u.lang AND y.phrase = u.g
  JOIN totals t ON t.lang = u.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
kept AS (SELECT * FROM lowest o WHERE NOT EXISTS (SELECT 1 FROM cand b WHERE b.lang = o.lang AND b.k > o.k
  AND contains(' ' || b.phrase || ' ', ' ' || o.phrase || ' ') AND 100 * b.a >= 100 * o.a))
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000""",
}
