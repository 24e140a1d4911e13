"""The operators applied to whole tables, with production parameters, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunk_store, clustering, decontaminate, erasure, language_id, license_scan, mixing, ngram_model, oracles, pii, quality_rules, simhash_dedup, substring_dedup, token_counts
from .license_scan import TRUST


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def licenses(docs: DataFrame) -> DataFrame:
    d = F.col("detections")
    base = F.filter(d, lambda x: x.base)
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda x: x.label))), ",")
    trust = F.create_map(*[F.lit(v) for kv in TRUST.items() for v in kv])
    return license_scan.detect(docs).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x.start)).alias("first_word"), F.array_max(F.transform(base, lambda x: x.start)).alias("last_word"),
        joined(base).alias("base_labels"), joined(d).alias("labels"), F.coalesce(F.array_max(F.transform(d, lambda x: trust[x.priority])), F.lit(0.0)).alias("score"),
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of each document.  Null and empty texts have no words and no labels, first_word and last_word null, score 0; repeated rows give equal rows."""
    return licenses(documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of each document by the public 32k vocabulary.  Null and empty texts count 0; repeated rows give equal rows."""
    return token_counts.count_tokens(documents(spark, sf_dir), "piece_bpe_32k.model")


def languages(docs: DataFrame) -> DataFrame:
    model = language_id.train(docs)
    found = language_id.predictor(docs, model)(F.col("text").cast("string"))
    return docs.select("doc_id", language_id.held_out().alias("held_out"), found.alias("r")).select("doc_id", "held_out", "r.lang_pred", "r.score", "r.rejected")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document.  Null texts and texts without a letter are `und`, score 0, rejected; a null doc_id is not held out; repeated rows give equal rows."""
    return languages(documents(spark, sf_dir))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document.  Null and empty texts have fingerprint zero and are linked; repeated rows give equal rows."""
    return simhash_dedup.near_duplicates(documents(spark, sf_dir))


def personal_data(docs: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s.base)
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in pii.BASE_KINDS]
    return pii.find(docs).select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each document.  Null and empty texts have none; repeated rows give equal rows."""
    return personal_data(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document stands in the mix by the square roots of the sources' sizes.  Null is a source of its own; each row has a place, also repeated ones and those without an id."""
    return mixing.mix(documents(spark, sf_dir))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents.  Null and empty texts and items match nothing; rows and items that share an id count as one, by their best window."""
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def passages(docs: DataFrame) -> DataFrame:
    return substring_dedup.dedup_passages(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses to documents with smaller ids.  Null and empty texts have no words; rows of one id, or without one, take nothing from each other."""
    return passages(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document.  Null and empty texts have no words and fail; null languages and sources count as empty ones; repeated rows give equal rows."""
    return quality_rules.judge(documents(spark, sf_dir))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document in the token store.  Null and empty texts are the end id alone; null ids come first; rows that share an id are documents of their own."""
    return chunk_store.encoded(documents(spark, sf_dir), "word_bpe_49k.json")


def op11_erasure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of the shop's tables after victim masters and all that hangs on them are erased.  Null keys refer to nothing; repeated rows go or stay together; an empty table has no files."""
    return erasure.erased_shop(spark, {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in erasure.MONEY})


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the whole vectors.  Vectors of another length or with a null or non-finite component are left out; repeated rows are vectors of their own."""
    return clustering.clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of each document.  Null and empty texts are their end alone; a null doc_id counts as an empty one; repeated rows give equal rows and count as often as they stand."""
    docs = documents(spark, sf_dir)
    held = ngram_model.is_held_out()
    return ngram_model.scored(docs, ~held).select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def lm_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13's base columns, which SQL can express; sums of logarithms to four digits."""
    return op13_lm_scoring(spark, sf_dir).withColumn("base_score", F.round("base_score", 4)).drop("score")


def license_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1's base columns, which SQL can express."""
    return op1_license_scan(spark, sf_dir).drop("labels", "score")


def pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5's base columns, which SQL can express."""
    return op5_pii(spark, sf_dir).drop("spans")


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9's counts and fixed limits, which SQL can express."""
    return quality_rules.measures(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_license_scan, op2_token_counts, op3_language_id, op4_simhash_dedup, op5_pii, op6_mixing, op7_decontamination, op8_substring_dedup, op9_quality_rules, op10_token_output, op11_erasure, op12_clustering, op13_lm_scoring)
    return {f.__name__: f for f in (*found, license_base, pii_base, quality_base, lm_base)}


def oracle_sql() -> dict[str, str]:
    """The others need XXH64, a tokenizer, centroids or iterated estimates, or write files: they are tested against brute force."""
    return dict(oracles.SQL)
