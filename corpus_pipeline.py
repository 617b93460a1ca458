"""A corpus, stage by stage, to packed training sequences.

Each stage reads what the one before it left, whole, and its decisions take effect: documents
of no known language go, of documents that are alike one stays, repeated stretches are cut,
secrets are replaced, and what is left is packed. All stages but the last return the columns
of ``documents``; ``n_chars`` follows the text.

In every stage: an empty table gives an empty one, texts are read whole however long, null
languages and sources stay as they are, and further columns pass through, except those named
``__lang``, ``__score``, ``__unnamed``, ``__kept``, ``__removed`` and ``__spans``, which the stages
use. Null and empty texts have no letters and go in the first stage. A doc_id names one text: rows with a
repeated doc_id and unlike texts go or stay together where documents are alike, and count as one
document where stretches repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmart.llm import langid, ngram_join, secrets, suffix_dedup
from wardmart.llm.common import among, written
from wardmart.llm.queries import packed, prepared, trained_language

#: A document whose likeliest language is less probable than this is rejected.
LANGUAGE_SCORE = 0.5
#: Words that a worker remembers while it packs; few, as executors carry other stages' memory.
PACK_WORDS = 150_000


def _with_text(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType)).select(like.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters and a language; ``lang`` becomes what was found."""
    prepared(spark)
    found = langid.predict(docs, trained_language(docs), ("__lang", "__score"))
    good = (F.col("__lang") != langid.UNDETERMINED) & (F.col("__score") >= LANGUAGE_SCORE)
    return found.where(good).withColumn("lang", F.col("__lang")).select(docs.columns)


def _once(docs: DataFrame) -> DataFrame:
    """``docs`` with one of its rows that are equal in doc_id, null included, and text."""
    numbered = docs.where("doc_id is not null")
    repeated = written(numbered.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    odd = among(numbered, repeated, "doc_id").unionByName(docs.where("doc_id is null"))
    if odd.isEmpty():
        return docs
    single = among(numbered, repeated, "doc_id", keep=False)
    return written(single.unionByName(odd.dropDuplicates(["doc_id", "text"])), "once")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links join: the one with the smallest doc_id. Of rows
    with equal doc_id and text one stays."""
    prepared(spark)
    kind, unnamed = docs.schema["doc_id"].dataType, F.col("doc_id").isNull()
    # Rows without a doc_id stand for themselves under numbers above all others.
    number = F.lit(1 << 62) + F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1))
    named = _once(docs).withColumns({"__unnamed": unnamed, "doc_id": F.coalesce(F.col("doc_id").cast("long"), number)})
    found = written(ngram_join.joined(named).where("component_id <> doc_id").select("doc_id"), "copies")
    kept = among(named, found, "doc_id", keep=False)
    return kept.withColumn("doc_id", F.when(~F.col("__unnamed"), F.col("doc_id")).cast(kind)).select(docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without stretches that appeared before; a character cut in half goes whole, and so
    does a document of which nothing is left."""
    prepared(spark)
    found = suffix_dedup.deduplicated(docs, ("__kept", "__removed", "__spans"), as_text=True)
    text = F.when(F.col("__removed") == 0, F.col("text")).otherwise(F.col("__kept"))
    left = found.where((F.col("__removed") == 0) | (F.length("__kept") > 0))
    return _with_text(left.withColumn("text", text), docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose secrets are replaced."""
    prepared(spark)
    return _with_text(secrets.redacted(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    prepared(spark)
    return packed(docs, PACK_WORDS)


STAGES = [
    ("language", language), ("near_duplicates", near_duplicates), ("repeats", repeats),
    ("redact", redact), ("pack", pack),
]

#: The stages are not expressible in SQL; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stage's table written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
