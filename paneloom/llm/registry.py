"""The queries of this subpackage, with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, line_dedup, media, merkle, mixing, ngram_join, pieces, pii, quality, sharding, simhash, url_filter
from .store import documents


def model_path(name: str = "piece_bpe_32k.model") -> str:
    """A public tokenizer; it is read where the driver and the executors have it installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(documents(spark, sf_dir))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir), k=3, pct=90)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir), min_chars=1).select("doc_id", "n_lines", "n_removed", "text")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(documents(spark, sf_dir), model_path())


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_media(documents(spark, sf_dir))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.rate(documents(spark, sf_dir), labels).select("doc_id", "expected_grade", "tail_prob", "keep")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = alignment.align(documents(spark, sf_dir), model_path("byte_bpe_50k.json"), model_path(), keep_groups=False)
    return rows.withColumnRenamed("groups", "groups_sha256")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    changed = merkle.leaf_digest(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.unhex(changed))
    out = merkle.fold(merkle.manifest(docs, also={"tampered": tampered}), F.col("tampered"))
    return out.select("doc_id", *[F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")], "proof_sha256", F.lower(F.hex("folded_root")).alias("folded_root"), "verified")


QUERIES = {f.__name__: f for f in (op1_pii, op2_ngram_jaccard, op3_sharding, op4_url_filter, op5_line_dedup, op6_ann, op7_pieces, op8_mixing, op9_media, op10_quality, op11_simhash, op12_alignment, op13_merkle)}

ORACLE_SQL = {
    "op5_line_dedup": """
WITH lines AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents
), spread AS (
  SELECT trim(line) AS line, min(doc_id) AS first_id FROM lines WHERE length(trim(line)) >= 1
  GROUP BY trim(line) HAVING count(DISTINCT coalesce(source, chr(1))) >= 5
), marked AS (
  SELECT l.doc_id, l.pos, l.line, s.line IS NOT NULL AND l.doc_id <> s.first_id AS gone FROM lines l LEFT JOIN spread s ON trim(l.line) = s.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
FROM marked GROUP BY doc_id""",
    "op8_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5('0:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source
), w AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w, 2 * source_size AS cap FROM src
), r AS (
  SELECT *, cap * 6 // w AS per FROM w
), c AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY per, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS cap_before,
         coalesce(sum(w) OVER (ORDER BY per, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS w_before FROM r
), level AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM src)::DOUBLE - cap_before) / ((SELECT sum(w) FROM r)::DOUBLE - w_before) AS level FROM c
), goal AS (
  SELECT source, source_size, least(cap::DOUBLE, (SELECT arg_min(level, (per, place)) FROM level WHERE level * w <= cap) * w) AS target FROM level
), budget AS (
  SELECT *, floor(target + 0.5)::BIGINT AS budget, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS passes FROM goal
)
SELECT s.doc_id, s.size, b.source_size, b.target,
       (b.passes * s.size + greatest(0, least(s.size, b.budget - b.passes * b.source_size - coalesce(sum(s.size) OVER (
          PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))))::BIGINT AS taken
FROM sized s JOIN budget b ON s.source IS NOT DISTINCT FROM b.source""",
    "op13_merkle": r"""
WITH RECURSIVE told AS (
  SELECT doc_id, lang, n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
               lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) AS crc
  FROM documents
), hashed AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
         CASE WHEN crc % 7 = 0 THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS tampered
  FROM told
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM hashed
), nodes(g, l, pos, n, d) AS (
  SELECT g, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT g, l + 1, pos // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY g, l, pos // 2, n
), tops(l, pos, n, d) AS (
  SELECT 0, g, count(*) OVER (), d FROM nodes WHERE n = 1
  UNION ALL
  SELECT l + 1, pos // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY l, pos // 2, n
), every AS (
  SELECT g, l, pos, n, d FROM nodes UNION ALL SELECT -1, l, pos, n, d FROM tops
), way(doc_id, leaf, own, g, l, pos, n, folded, sibs) AS (
  SELECT doc_id, leaf, g, g, 0, pos, n, coalesce(tampered, leaf), '' FROM placed
  UNION ALL
  SELECT w.doc_id, w.leaf, w.own, CASE WHEN w.n = 1 THEN -1 ELSE w.g END, CASE WHEN w.n = 1 THEN 0 ELSE w.l + 1 END,
         CASE WHEN w.n = 1 THEN w.g ELSE w.pos // 2 END, CASE WHEN w.n = 1 THEN (SELECT count(DISTINCT g) FROM placed) ELSE (w.n + 1) // 2 END,
         CASE WHEN w.n = 1 THEN w.folded WHEN w.pos % 2 = 1 THEN sha256(s.d || w.folded) ELSE sha256(w.folded || coalesce(s.d, '')) END,
         w.sibs || coalesce(s.d, '')
  FROM way w LEFT JOIN every s ON w.n > 1 AND s.g = w.g AND s.l = w.l AND s.pos = xor(w.pos, 1)
  WHERE w.n > 1 OR w.g >= 0
), root AS (SELECT d FROM tops WHERE n = 1), sub AS (SELECT g, d FROM nodes WHERE n = 1)
SELECT w.doc_id, w.leaf, s.d AS subroot, r.d AS root, sha256(w.sibs) AS proof_sha256, w.folded AS folded_root, w.folded = r.d AS verified
FROM way w JOIN sub s ON s.g = w.own, root r WHERE w.n = 1 AND w.g = -1""",
}
