"""Exact deduplication by progressive refinement: length, then a prefix hash, then the full hash.

Only rows whose length and prefix hash occur more than once have their full text hashed. The
surviving keys become a bitmap of bounded size that is tested in the scan, so that unique rows
never leave their task; an exact semi-join settles the rest.

Cases: a null text counts as empty; a null id counts as smaller than any id (a group of null ids
keeps a null id); rows repeated whole under one id are one document: marks give them one fate, and
drop_duplicates() leaves one of them; an empty table gives an empty result; other columns pass
unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap_of, free_names, marked, materialize, maybe_in, salted_left_join

PREFIX_CHARS = 64


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row a text that occurs more than once: text_sha256, keep_id (largest id), group_size."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.select("id", "t", F.octet_length("t").alias("len"), F.xxhash64(F.substring("t", 1, prefix_chars)).alias("prefix"))
    by_length = rows.select("len", "prefix").groupBy("len", "prefix").agg(F.count(F.lit(1)).alias("n"))
    # a length of its own needs no prefix; one aggregation by both gives either level
    keys = materialize(by_length.filter("n > 1").select("len", "prefix"), "dedup-keys")
    key = F.xxhash64("len", "prefix")
    survivors = maybe_in(rows, key, bitmap_of(keys, key))
    hashed = survivors.select("id", "len", "prefix", F.sha2("t", 256).alias("text_sha256"))
    full = hashed.groupBy("len", "prefix", "text_sha256").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return full.filter("group_size > 1").join(keys, ["len", "prefix"], "left_semi").select("text_sha256", "keep_id", "group_size")


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with keep_id, group_size, kept and text_sha256; the row with the largest id of equal texts is kept."""
    sha, keep_, size = free_names(docs, "_sha", "_keep", "_size")
    groups = materialize(duplicate_groups(docs, id_col, text_col), "dedup-groups").withColumnsRenamed({"keep_id": keep_, "group_size": size, "text_sha256": sha})
    rows = docs.drop("keep_id", "group_size", "kept", "text_sha256").withColumn(sha, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    joined = salted_left_join(rows, groups, [sha], F.xxhash64(id_col))
    keep = F.when(F.col(size).isNull(), F.col(id_col)).otherwise(F.col(keep_))
    return joined.select(
        *[F.col(c) for c in docs.columns if c not in ("keep_id", "group_size", "kept", "text_sha256")],
        keep.alias("keep_id"), F.coalesce(size, F.lit(1)).cast("long").alias("group_size"),
        F.col(id_col).eqNullSafe(keep).alias("kept"), F.col(sha).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each text, with the columns of docs: that with the largest id, and of rows repeated under it the least by its other columns.

    Rows whose length and prefix are their own stay in their task. Of the others only those of texts
    that do occur twice are moved.
    """
    key, sha, maybe, keep, size, top, row = free_names(docs, "_key", "_sha", "_maybe", "_keep", "_size", "_top", "_row")
    text = F.coalesce(F.col(text_col), F.lit(""))
    groups = materialize(duplicate_groups(docs, id_col, text_col), "dedup-groups").withColumnsRenamed({"keep_id": keep, "group_size": size, "text_sha256": sha})
    looked = marked(docs.withColumn(sha, F.sha2(text, 256)), F.xxhash64(sha), bitmap_of(groups, F.xxhash64(sha)), maybe)
    stay, close = looked.filter(~F.col(maybe)), looked.filter(F.col(maybe))
    close = salted_left_join(close, groups, [sha], F.xxhash64(id_col)).filter(F.col(size).isNull() | F.col(id_col).eqNullSafe(F.col(keep)))
    # one of the rows that repeat under the largest id
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    one = close.withColumns({row: F.xxhash64(F.to_json(F.struct(*rest))) if rest else F.lit(0), key: F.coalesce(F.col(id_col).cast("string"), F.lit("null"))})
    one = one.groupBy(sha, key).agg(F.min_by(F.struct(*docs.columns), row).alias(top)).select(f"{top}.*")
    return stay.select(docs.columns).unionByName(one.select(docs.columns))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return mark_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
