"""The queries of this subpackage over the tables of a scale folder, and DuckDB SQL where that can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from canopy.llm import bpe, embedding_dedup, exact_dedup, lm_score, mixing, ngram_join, resharding, secrets, substring_dedup, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(_table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.groups(_table(spark, sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return exact_dedup.decide(docs, exact_dedup.earlier(docs))


def op10_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharding.reshard(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_lm_score": op3_lm_score,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_mixing": op5_mixing,
    "op6_toxicity": op6_toxicity,
    "op7_secrets": op7_secrets,
    "op8_bpe": op8_bpe,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_resharding": op10_resharding,
}

_WORDS = r"regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op1_ngram_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
g AS (
  SELECT doc_id, list_sort(list_distinct(
    CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s
  FROM w WHERE len(w) > 0),
d AS (SELECT DISTINCT doc_id, s, len(s) AS n FROM g),
e AS (SELECT min(doc_id) AS rep, s, n, count(*) AS docs FROM d GROUP BY s, n),
x AS (SELECT rep, unnest(s) AS gram FROM e),
p AS (SELECT a.rep AS ra, b.rep AS rb, count(*) AS c FROM x a JOIN x b ON a.gram = b.gram AND a.rep < b.rep GROUP BY 1, 2),
m AS MATERIALIZED (SELECT ra, rb FROM p JOIN e a ON a.rep = ra JOIN e b ON b.rep = rb WHERE c / (a.n + b.n - c) >= 0.6),
l AS MATERIALIZED (SELECT ra AS one, rb AS two FROM m UNION ALL SELECT rb, ra FROM m),
r(rep, to_) AS (SELECT rep, rep FROM e UNION SELECT r.rep, l.two FROM r JOIN l ON l.one = r.to_),
c AS (SELECT rep, min(to_) AS winner FROM r GROUP BY rep),
k AS (SELECT one AS rep, sum(docs) AS links FROM l JOIN e ON e.rep = l.two GROUP BY one)
SELECT d.doc_id, c.winner, CAST(e.docs - 1 + coalesce(k.links, 0) AS BIGINT) AS n_links
FROM d JOIN e ON e.s = d.s JOIN c ON c.rep = e.rep LEFT JOIN k ON k.rep = e.rep
UNION ALL SELECT DISTINCT doc_id, doc_id, 0 FROM documents WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM d)""",
    "op4_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS x FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
l AS MATERIALIZED (SELECT a.id AS one, b.id AS two FROM v a JOIN v b ON a.id <> b.id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
r(id, to_) AS (SELECT one, one FROM l UNION SELECT r.id, l.two FROM r JOIN l ON l.one = r.to_)
SELECT id AS vec_id, min(to_) AS component FROM r GROUP BY id""",
    "op5_mixing": r"""
WITH t AS (
  SELECT coalesce(source, '(none)') AS source, doc_id, len(regexp_extract_all(coalesce(text, ''), '\S+')) AS tokens,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
p AS (SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY key, doc_id, tokens ROWS UNBOUNDED PRECEDING) - tokens AS a FROM t),
s AS (SELECT source, sum(tokens)::HUGEINT AS total, floor(sqrt(sum(tokens)::DOUBLE) * sqrt(sqrt(sum(tokens)::DOUBLE)))::HUGEINT AS share
  FROM t GROUP BY source HAVING sum(tokens) > 0),
e AS (SELECT source, total, share, sum(share) OVER () AS whole, sum(share) OVER (ORDER BY source)::HUGEINT AS cum FROM s),
f AS (SELECT *, (cum - share) * 2147483648 // whole::HUGEINT AS low, cum * 2147483648 // whole::HUGEINT AS high FROM e),
n AS (SELECT max((((total + 4095) // 4096 + 4) * whole::HUGEINT + share - 1) // share) AS slots FROM e),
i AS (SELECT unnest(range(0, (SELECT slots FROM n)::BIGINT)) AS slot),
g AS (SELECT slot, source, total, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
  FROM i JOIN f ON (slot % 2147483648) * 1327217885 % 2147483648 >= low AND (slot % 2147483648) * 1327217885 % 2147483648 < high),
u AS (SELECT source, any_value(total)::BIGINT AS total, count(*) * 4096 AS used FROM g GROUP BY source),
r AS (SELECT p.source, doc_id, tokens, used, unnest(range(0, ((used - 1 - a) // total + 1)::BIGINT)) AS epoch, a::BIGINT AS a, total
  FROM p JOIN u ON p.source = u.source WHERE tokens > 0 AND a < used),
b AS (SELECT *, a + epoch * total AS b0 FROM r),
c AS (SELECT *, unnest(range(b0 // 4096, (least(b0 + tokens, used) - 1) // 4096 + 1)) AS rank FROM b)
SELECT slot, c.source, c.rank, doc_id, epoch, greatest(b0, c.rank * 4096) - b0 AS from_token,
  least(b0 + tokens, (c.rank + 1) * 4096) - greatest(b0, c.rank * 4096) AS tokens
FROM c JOIN g ON c.source = g.source AND c.rank = g.rank""",
    "op9_exact_dedup": """
SELECT DISTINCT doc_id, CASE WHEN text IS NULL THEN doc_id ELSE first END AS winner,
  text IS NOT NULL AND doc_id IS DISTINCT FROM first AS is_repeat, text IS NOT NULL AND coalesce(known, false) AS member
FROM (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text) AS first,
  bool_or(doc_id <= (SELECT (min(doc_id) + max(doc_id)) // 2 FROM documents)) OVER (PARTITION BY text) AS known FROM documents)""",
}
