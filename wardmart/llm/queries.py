"""The registered queries: each operator on its whole table, and their SQL."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmart.llm import (
    audits_sql, bpe, chat, divergence, drift_clusters, langid, multi_index, near_vectors, ngram_join, packing,
    quality, secrets, suffix_dedup, topk,
)
from wardmart.llm.common import written

BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

_SHIPPED: set[str] = set()


def prepared(spark: SparkSession) -> None:
    """Sends this package to the workers unless their path already has it; small batches."""
    root = Path(__file__).resolve().parents[2]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    app = spark.sparkContext.applicationId
    on_path = str(root) in os.environ.get("PYTHONPATH", "").split(":")
    if on_path or app in _SHIPPED:
        return
    _SHIPPED.add(app)
    with tempfile.NamedTemporaryFile(suffix=".zip", delete=False) as f, zipfile.ZipFile(f, "w") as z:
        for p in sorted((root / "wardmart").rglob("*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(f.name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(parts: int):
    """crc32 of doc_id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))


def similar(spark, sf_dir):
    return ngram_join.joined(table(spark, sf_dir, "documents"))


QUALITY_FOLDS, QUALITY_LIMIT = 5, 0.3


def quality_scores(spark, sf_dir):
    stats = written(quality.described(table(spark, sf_dir, "documents")), "statistics")
    held_out = F.coalesce(_remainder(QUALITY_FOLDS) == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "quality")
    found = quality.scored(stats, quality.fit(stats, labels))
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= QUALITY_LIMIT).cast("int").alias("predicted"))


def byte_bpe(spark, sf_dir):
    found = bpe.decode(
        bpe.encode(table(spark, sf_dir, "documents"), BPE_RANKS, public_tokenizers.PATTERN), BPE_RANKS)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


LANGUAGE_PIECES = BPE_RANKS
LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 4, 2


def _language_held_out():
    return F.coalesce(_remainder(LANGUAGE_FOLDS) == LANGUAGE_HELD_OUT, F.lit(False))


def trained_language(docs: DataFrame) -> langid.Model:
    return langid.fit(docs.where(~_language_held_out()), LANGUAGE_PIECES)


def languages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), trained_language(docs))
    return found.select("doc_id", _language_held_out().alias("held_out"), "lang_pred", "score")


def conversations(spark, sf_dir):
    return chat.formatted(table(spark, sf_dir, "conversations"))


def repeats(spark, sf_dir):
    found = suffix_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "n_removed", "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"))


def _count_of(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias("n_" + kind)


def _joined_spans(column: str):
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_spans(spark, sf_dir):
    found = secrets.scanned(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *map(_count_of, secrets.KINDS), F.sha2(_joined_spans("base").cast("binary"), 256).alias("base_sha256"),
        _joined_spans("spans").alias("spans"))


def embedding_copies(spark, sf_dir):
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def packed(docs: DataFrame, words: int = packing.WORDS) -> DataFrame:
    found = packing.pieces(docs, WORD_BPE, words=words)
    return packing.pack(found.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def pack(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))


def top_five(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top(vectors, F.pmod("vec_id", F.lit(50)) == 0, 5)


def source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=10, most=10)


def centroid_clusters(spark, sf_dir):
    return drift_clusters.clusters(
        table(spark, sf_dir, "embeddings"), k=audits_sql.CLUSTERS, rounds=audits_sql.ROUNDS, scale=64, dim=64)


def nearest_ten(spark, sf_dir):
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0, 10)


QUERIES = {
    "op1_ngram_join": similar,
    "op2_quality": quality_scores,
    "op3_byte_bpe": byte_bpe,
    "op4_language": languages,
    "op5_chat_format": conversations,
    "op6_suffix_dedup": repeats,
    "op7_secrets": secret_spans,
    "op8_near_vectors": embedding_copies,
    "op9_packing": pack,
    "op10_top_k": top_five,
    "op11_divergence": source_divergence,
    "op12_clusters": centroid_clusters,
    "op13_nearest": nearest_ten,
}

# Conversations as lists of turns; one that starts another, longer list, or equals one of a
# smaller conv_id, goes.
_CHAT = """
with c as (
  select conv_id, list({'r': role, 't': text}
    order by turn nulls first, role nulls first, text nulls first) as turns
  from conversations where conv_id is not null group by conv_id),
kept as (
  select a.conv_id from c a where not exists (
    select 1 from c b where b.turns[1].t is not distinct from a.turns[1].t
      and (len(b.turns) > len(a.turns) or len(b.turns) = len(a.turns) and b.conv_id < a.conv_id)
      and b.turns[1:len(a.turns)] = a.turns)),
r as (
  select conv_id, turn, role,
    row_number() over w as place,
    '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) as rendered
  from conversations where conv_id in (select conv_id from kept)
  window w as (partition by conv_id order by turn nulls first, role nulls first, text nulls first))
select conv_id, place, turn, role, rendered,
  coalesce(sum(length(rendered)) over (
    partition by conv_id order by place rows between unbounded preceding and 1 preceding), 0)::bigint as start_char
from r
"""

_TOP = """
with v as (
  select vec_id, [floor(256 * x::double) for x in embedding] as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on c.vec_id <> q.vec_id and len(c.e) = len(q.e) where q.vec_id % 50 = 0),
r as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from s)
select query_id, rank::integer as rank, vec_id, score from r where rank <= 5
"""

ORACLES: dict[str, str] = {
    "op1_ngram_join": audits_sql.NGRAMS, "op5_chat_format": _CHAT, "op10_top_k": _TOP, "op11_divergence": audits_sql.DIVERGENCE,
    "op12_clusters": audits_sql.CENTROIDS}
