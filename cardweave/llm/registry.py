"""Queries of the training-data operators and, where SQL can say it, their expected results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cardweave.llm.clusters import cluster_vectors
from cardweave.llm.decontaminate import contaminated
from cardweave.llm.divergence import source_divergence
from cardweave.llm.lines import lines_digest
from cardweave.llm.minhash import near_duplicates
from cardweave.llm.packing import pack_documents
from cardweave.llm.pii import personal_data_digest
from cardweave.llm.quality import judge_quality
from cardweave.llm.repeats import repeats_digest
from cardweave.llm.search import top_k
from cardweave.llm.sharding import shard_documents
from cardweave.llm.token_files import tokens_digest
from cardweave.llm.toxicity import judge_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _over_documents(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(_table(spark, sf_dir, "documents"))


def _judged(judge: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        judged = judge(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
        return judged.select("doc_id", "held_out", "score", "predicted")

    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": _over_documents(pack_documents),
    "op2_line_dedup": _over_documents(lines_digest),
    "op3_rendezvous_sharding": _over_documents(shard_documents),
    "op4_personal_data": _over_documents(personal_data_digest),
    "op5_exact_top_k": lambda spark, sf_dir: top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0),
    "op6_benchmark_decontamination": lambda spark, sf_dir: contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    ),
    "op7_quality_classifier": _judged(judge_quality),
    "op8_minhash_near_dedup": _over_documents(lambda df: near_duplicates(df, words=2)),
    "op9_toxicity": _judged(judge_toxicity),
    "pipeline": corpus_pipeline.run,
    "op10_suffix_array_dedup": _over_documents(repeats_digest),
    "op11_centroid_clustering": lambda spark, sf_dir: cluster_vectors(_table(spark, sf_dir, "embeddings")),
    "op12_token_files": _over_documents(tokens_digest),
    "op13_source_divergence": _over_documents(source_divergence),
}

_LINES = r"""
WITH lines AS (
  SELECT doc_id, n, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS n
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
keyed AS (
  SELECT doc_id, n, line, translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
firsts AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
judged AS (
  SELECT k.*, f.first_doc IS NOT NULL AND k.doc_id > f.first_doc AS gone FROM keyed k LEFT JOIN firsts f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_TOP_K = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS ints FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.ints, v.ints)::BIGINT AS score
  FROM vectors q JOIN vectors v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""

_NEAR = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, e.b FROM reached r JOIN either e ON e.a = r.other),
components AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN components USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""



def _clusters(rounds: int = 3, k: int = 16) -> str:
    """The rounds, one after the other: distances, nearest centroids, floored means."""

    def nearest(r: int) -> str:
        return f"""
s{r} AS (SELECT v.row, c.cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
         FROM points v JOIN c{r} c USING (d) GROUP BY ALL),
n{r} AS (SELECT row, cluster, distance FROM s{r}
         QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1)"""

    def moved(r: int) -> str:
        return f""",
m{r} AS (SELECT cluster, d, sum(x)::BIGINT AS total, count(*) AS n FROM points JOIN n{r} USING (row) GROUP BY ALL),
c{r + 1} AS (SELECT cluster, d, coalesce((total - ((total % n) + n) % n) // n, x) AS x
         FROM c{r} LEFT JOIN m{r} USING (cluster, d)),"""

    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
points AS (SELECT row, d, floor(64 * embedding[d]::DOUBLE)::BIGINT AS x FROM kept, range(1, 65) AS t(d)),
firsts AS (SELECT row, (row_number() OVER (ORDER BY sha256('1:' || vec_id), row))::INTEGER - 1 AS cluster FROM kept),
c0 AS (SELECT cluster, d, x FROM points JOIN firsts USING (row) WHERE cluster < {k}),
{"".join(nearest(r) + moved(r) for r in range(rounds))}
{nearest(rounds)},
digests AS (SELECT cluster, sha256(string_agg(x, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM n{rounds} JOIN kept USING (row) JOIN digests USING (cluster)
"""


_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
places AS (SELECT DISTINCT lang, source FROM docs),
found AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (
  SELECT lang, source, term, coalesce(n, 0) AS n FROM places JOIN kept USING (lang) LEFT JOIN found USING (lang, source, term)),
own AS (
  SELECT *, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER g + 2 * count(*) OVER g) AS p
  FROM dense WINDOW g AS (PARTITION BY lang, source)),
whole AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER g + 2 * count(*) OVER g) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM dense GROUP BY lang, term) WINDOW g AS (PARTITION BY lang)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM places a JOIN places b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM own JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (FROM pairs UNION ALL FROM terms))
WHERE part = 'pair' OR rank <= 10
"""

ORACLES: dict[str, str] = {
    "op11_centroid_clustering": _clusters(),
    "op13_source_divergence": _DIVERGENCE,
    "op2_line_dedup": _LINES,
    "op5_exact_top_k": _TOP_K,
    "op8_minhash_near_dedup": _NEAR,
}
