"""The corpus pipeline: documents in, encoded training texts out.

Stages, each over all that the one before kept:

1. toxicity: documents predicted toxic go.
2. near duplicates: of each group of documents linked by five-word shingles (Jaccard of at
   least 0.75), the one with the smallest doc_id stays.
3. substring dedup: words of 50-word passages that also start in a smaller doc_id go.
4. decontamination: words of benchmark passages go.
5. encoding: the texts' SentencePiece ids.

All but the last return the columns of documents.  A text that loses words has ``n_chars``
brought up to date; one that does not stays byte for byte.  Rows without doc_id are never
duplicates of others and stay; rows that repeat a doc_id with another text are documents of
their own, and rows that repeat both become one: the first by their other columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from listinglake.llm.common import settle, table
from listinglake.llm.decontaminate import remove_hits
from listinglake.llm.ngram_join import jaccard_components
from listinglake.llm.piece_codec import encode_decode
from listinglake.llm.substring_dedup import remove_repeats
from listinglake.llm.toxicity import score_documents


# The columns that no operator looks at travel as one, so that none can clash with an
# operator's own.
ROW, ROW_HASH, ROW_RANK = "__row", "__text_hash", "__rank"


def _apart(docs: DataFrame) -> DataFrame:
    rest = [f"`{c}`" for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest, F.lit(0).alias("_")).alias(ROW))


def _together(rows: DataFrame, like: DataFrame) -> DataFrame:
    """``rows`` of ``_apart`` with the columns of ``like``; ``n_chars`` of the present text."""

    def column(field):
        if field.name in ("doc_id", "text"):
            return F.col(field.name)
        if field.name == "n_chars":
            return F.length("text").cast(field.dataType).alias("n_chars")
        return F.col(f"{ROW}.`{field.name}`")

    return rows.select(*[column(f) for f in like.schema.fields])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = score_documents(_apart(docs), table(spark, sf_dir, "labels"))
    return _together(scored.where("predicted = 0"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_components(docs.select("doc_id", "text"))
    # One document of each group: its smallest id, and of several texts under that id one.
    kept = (
        found.where("id = component_id")
        .groupBy(F.col("id").alias("doc_id"), F.coalesce("group", "text_hash").alias("group"))
        .agg(F.min("text_hash").alias(ROW_HASH))
        .select("doc_id", ROW_HASH)
        .distinct()
    )
    rows = _apart(docs).withColumn(ROW_HASH, F.xxhash64("text"))
    named = rows.where("doc_id is not null").join(kept, ["doc_id", ROW_HASH], "left_semi")
    # A document that stands there twice is a copy of itself.
    first = W.partitionBy("doc_id", ROW_HASH).orderBy(F.to_json(ROW))
    named = named.withColumn(ROW_RANK, F.row_number().over(first)).where(F.col(ROW_RANK) == 1)
    return _together(named.drop(ROW_RANK).unionByName(rows.where("doc_id is null")), docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return _together(remove_repeats(_apart(docs)).withColumn("text", text), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _together(remove_hits(_apart(docs), table(spark, sf_dir, "benchmark")), docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = encode_decode(docs, path, keep_words=False)
    return coded.select("doc_id", "text", "lang", "source", "n_tokens", "ids", "ids_sha256")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# Learnt scores, connected groups and SentencePiece are beyond SQL; the tests compare the
# pipeline with plain Python on a small corpus instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = settle(docs, f"stage-{name}")
    return docs
