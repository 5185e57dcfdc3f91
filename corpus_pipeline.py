"""A training corpus from `documents`: quality, exact copies, near copies, benchmark leaks, packing.

Each stage works on all that the one before has kept. run() writes every stage's result to the
shared folder and reads it back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import free_names, materialize, sized, without
from tidemill.llm.decontaminate import remove_contaminated
from tidemill.llm.exact_dedup import drop_duplicates
from tidemill.llm.ngram_join import near_duplicates
from tidemill.llm.packing import pack_texts, public_tokenizer
from tidemill.llm.quality_crf import fit_quality_model, learnable, score_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose quality score is under 0.3.

    A null text is scored as an empty one; repeated rows share one fate; an empty table stays empty.
    """
    model = fit_quality_model(docs, learnable(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return score_quality(docs, model).filter("predicted = 1").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays (a null id is the least), of rows repeated under it one.

    Null texts and empty ones are equal; an empty table stays empty.
    """
    return drop_duplicates(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by Jaccard similarity >= 0.8 on five-word shingles the row with the lowest id stays (null ids come last).

    A row is its id and text. Where an id is null or has several texts, rows get keys of their own, so that no
    row goes for another's text. Texts without words link with nothing and stay; an empty table stays empty.
    """
    rows = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    unclear = rows.groupBy("doc_id").agg(F.count_distinct("sha").alias("texts")).filter("texts > 1 OR doc_id IS NULL").select("doc_id")
    unclear = materialize(unclear, "near-unclear")
    if unclear.isEmpty():
        groups = near_duplicates(docs.select("doc_id", "text"), width=5, percent=80)
        lost = materialize(groups.filter("component_id <> doc_id").select("doc_id").distinct(), "near-lost")
        return without(docs, lost, "doc_id").select(*docs.columns)
    key, sha = free_names(docs, "_key", "_sha")
    own = rows.alias("r").join(sized(unclear).alias("u"), F.col("r.doc_id").eqNullSafe(F.col("u.doc_id")), "left_semi").distinct()
    least = docs.agg(F.least(F.coalesce(F.min("doc_id"), F.lit(0)), F.lit(0))).first()[0]
    own = materialize(own.select("doc_id", F.col("sha").alias(sha), (F.lit(least).cast("long") - 1 - F.monotonically_increasing_id()).alias(key)), "near-keys")
    hashed = docs.withColumn(sha, F.sha2(F.coalesce("text", F.lit("")), 256)).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col(f"d.{sha}") == F.col(f"o.{sha}"))
    own = sized(own)
    keyed = hashed.join(own.alias("o"), same, "left").select("d.*", F.coalesce(f"o.{key}", "d.doc_id").alias(key))
    keyed = materialize(keyed.drop(sha), "near-keyed")
    groups = near_duplicates(keyed.select(key, "text"), id_col=key, width=5, percent=80).select(key, "component_id").distinct()
    grouped = materialize(groups.join(own, key, "left").select(key, "component_id", F.when(F.col(sha).isNull(), F.col(key)).otherwise(F.col("doc_id")).alias("doc_id"), sha), "near-groups")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", sha, key)
    stays = sized(grouped).groupBy("component_id").agg(F.min(first).alias("first")).select(F.col(f"first.{key}").alias(key))
    lost = materialize(grouped.join(stays, key, "left_anti").select(key), "near-lost")
    return without(keyed, lost, key).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go.

    Null and empty texts contain none and stay; repeated rows share one fate; without items all stay.
    """
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece of a sequence of at most 2048 tokens, with its token ids: the training corpus.

    A null or empty text is the end token alone; repeated rows are packed each; an empty table gives no rows.
    """
    return pack_texts(docs.select(F.col("doc_id").alias("id"), "text"), public_tokenizer(), with_ids=True)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pack", pack)]
ORACLE_SQL = None  # a classifier, packing and BM25 are beyond SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
