"""From raw documents to a token store: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm import chunk_store, decontaminate, language_id, mixing, simhash_dedup
from pitchline.llm.common import Workspace


def whole_row(docs: DataFrame) -> Column:
    """The row as one struct, beside which columns of any name can stand."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those that the classifier rejects go.

    So do null texts, texts without a letter, and all if no label teaches a language.  Repeated rows stay as often as they stand.
    """
    return language_id.keep_identified(docs, language_id.train(docs))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the first by doc_id (null last) and text; rows that share a doc_id alone are no duplicates.

    Of equal rows one stays, as of rows that share doc_id and text.  Null and empty texts are duplicates of one another.
    """
    firsts = simhash_dedup.representatives(docs).select(F.col("doc_id").alias("first"), F.col("digest").alias("of"))
    keyed = docs.select(whole_row(docs), F.col("doc_id").alias("id"), simhash_dedup.text_digest().alias("digest"))
    kept = keyed.join(firsts, keyed["id"].eqNullSafe(firsts["first"]) & (keyed["digest"] == firsts["of"]), "left_semi")
    return kept.dropDuplicates(["id", "digest"]).select("whole.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found; each row is judged by its own text, whatever its doc_id.

    Null and empty texts and items match nothing; repeated rows go or stay together; without a benchmark all stay.
    """
    judged = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    texts = docs.select(judged.alias("doc_id"), "text")
    found = decontaminate.contaminated(texts, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc_id").alias("leak")).distinct()
    keyed = docs.select(whole_row(docs), judged.alias("judged"))
    return keyed.join(found, keyed["judged"] == found["leak"], "left_anti").select("whole.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: the files follow it.

    Null is a source of its own; rows that are equal, share a doc_id or have none are each kept.
    """
    return mixing.mixed_documents(docs)


def stored(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store's rows, read back from its files.

    Documents read from files are stored in the order of the files, which is that of the mix; others by doc_id.  Null and empty
    texts are the end id alone; each row is a document of its own.
    """
    file = "word_bpe_49k.json"
    try:
        part, _, row = mixing.file_row(docs)
        docs.select(part, row)
    except AnalysisException:  # not read from files
        return chunk_store.encoded(docs, file)
    return chunk_store.encoded(docs, file, (part, row))


STAGES = [("language ID", identified), ("SimHash near-dedup", deduplicated), ("benchmark decontamination", decontaminated), ("mixing", mixed), ("token output", stored)]

#: Hashes over bit vectors, centroids and a tokenizer are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; what each returns is written and read again."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = work.save(stage(spark, docs, sf_dir), f"stage{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
