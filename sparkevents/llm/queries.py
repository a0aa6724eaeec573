"""One query per operator over its whole table, with production parameters, and the SQL where SQL can express it."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, embdedup, langid, lm, manifest, mixing, packing, pieces, quality, secrets, simhash, topk, toxicity
from .common import held_out, learnable, table


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.train(docs, learnable(3, 1)))
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "language.lang_pred", "language.score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.scored(docs, labels, learnable(5, 0), held_out(5, 1))
    predicted = F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", predicted.alias("predicted"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learnable(3, 1))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    predicted = F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", predicted.alias("predicted"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embdedup.near_duplicates(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS u, vec_id AS v FROM embeddings
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
), n AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
SELECT reach.u AS vec_id, coalesce(any_value(n_links), 0)::BIGINT AS n_links, min(reach.v) AS component_id,
       min(reach.v) = reach.u AS kept
FROM reach LEFT JOIN n ON n.u = reach.u GROUP BY reach.u
"""


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), learnable(7, 2), held_out(7, 2))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", *[f"mix.{c}" for c in ("size", "source_size", "target", "taken")])


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.train(secrets.labelled_samples(docs))
    return secrets.digests(secrets.scan(docs, model))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    shown = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", shown.alias("fingerprint"), "component_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [manifest.field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    altered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaves = docs.select(
        "doc_id", "lang", manifest.digest(*fields, manifest.field(F.col("text"))).alias("leaf"),
        F.when(altered, manifest.digest(*fields, manifest.field(lowered))).alias("claim"),
    )
    found = manifest.proofs(manifest.manifest(leaves, "lang", ["doc_id"], "leaf", ["doc_id", "claim"]))
    shown = found.select(
        "carried.doc_id", "leaf", "subroot", "root", manifest.proof_digest("path").alias("proof_sha256"),
        manifest.folded("path", F.coalesce("carried.claim", "leaf")).alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


OP11_SQL = """
WITH RECURSIVE f AS (
  SELECT doc_id, lang, text,
         concat(CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END,
                CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
                CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END,
                CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END) AS head,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
         xor(list_reduce(list_concat([4294967295], [ascii(c)::BIGINT FOR c IN regexp_extract_all(doc_id::VARCHAR, '.')]),
           lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
             lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 3 = 0 AS altered
  FROM documents
), d AS (
  SELECT doc_id, lang, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
         CASE WHEN altered
              THEN sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(lowered) || ':' || lowered END) END AS claim
  FROM f
), leaves AS (
  SELECT doc_id, claim, 0 AS level, coalesce('=' || lang, '-') AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS node,
         count(*) OVER (PARTITION BY lang) AS n
  FROM d
), low AS (
  SELECT level, tree, i, node, n FROM leaves
  UNION ALL
  SELECT level + 1, tree, i // 8, sha256(string_agg(node, '' ORDER BY i)), any_value((n + 7) // 8)
  FROM low WHERE n > 1 GROUP BY level, tree, i // 8
), tops AS (
  SELECT tree AS name, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n
  FROM low WHERE n = 1
), high AS (
  SELECT 1000 AS level, '' AS tree, i, subroot AS node, n FROM tops
  UNION ALL
  SELECT level + 1, tree, i // 8, sha256(string_agg(node, '' ORDER BY i)), any_value((n + 7) // 8)
  FROM high WHERE n > 1 GROUP BY level, tree, i // 8
), nodes AS (SELECT * FROM low UNION ALL SELECT * FROM high), steps AS (
  SELECT a.tree, a.level, a.i, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
         coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.i // 8 = b.i // 8
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.i
), walk AS (
  SELECT l.tree AS name, l.i AS leaf_i, 0 AS level, l.tree, l.i, '' AS proof, coalesce(l.claim, l.node) AS node FROM leaves l
  UNION ALL
  SELECT w.name, w.leaf_i, CASE WHEN s.i IS NULL THEN 1000 ELSE w.level + 1 END, CASE WHEN s.i IS NULL THEN '' ELSE w.tree END,
         CASE WHEN s.i IS NULL THEN t.i ELSE w.i // 8 END, w.proof || coalesce(s.before || s.after, ''),
         CASE WHEN s.i IS NULL THEN w.node ELSE sha256(s.before || w.node || s.after) END
  FROM walk w JOIN tops t ON t.name = w.name
  LEFT JOIN steps s ON s.tree = w.tree AND s.level = w.level AND s.i = w.i
  WHERE s.i IS NOT NULL OR w.tree <> ''
)
SELECT l.doc_id, l.node AS leaf, t.subroot, r.node AS root, sha256(w.proof) AS proof_sha256, w.node AS folded_root,
       w.node = r.node AS verified
FROM leaves l JOIN tops t ON t.name = l.tree JOIN high r ON r.n = 1
JOIN walk w ON w.name = l.tree AND w.leaf_i = l.i AND w.tree = ''
  AND NOT EXISTS (SELECT 1 FROM steps s WHERE s.tree = '' AND s.level = w.level AND s.i = w.i)
"""


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.aligned(table(spark, sf_dir, "documents"))
    shown = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    found = alignment.counted(found.withColumn("groups_sha256", shown).drop("groups"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = pieces.shared(spark.sparkContext)
    found = pieces.decode(pieces.encode(docs, vocabulary=model), vocabulary=model)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_language_id": op3_language_id,
    "op4_quality": op4_quality,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_source_mixing": op9_source_mixing,
    "op10_secret_scan": op10_secret_scan,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_alignment": op12_token_alignment,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLES: dict[str, str] = {"op1_exact_top_k": OP1_SQL, "op7_embedding_dedup": OP7_SQL, "op11_merkle_manifest": OP11_SQL}
