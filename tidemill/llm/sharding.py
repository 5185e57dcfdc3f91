"""Shuffling into shards by a two-pass external shuffle, in DataFrame operations only.

Pass one scatters rows into memory-sized buckets by a seeded hash of the row's place in the input,
so that no id, source or group of copies can fill a bucket; each bucket is a task of its own. Pass two
shuffles each bucket's places (sorted, then the built-in array shuffle, a Fisher-Yates shuffle by a seed), gives
each row the rank of its place, and writes the rows in the order of their ranks. Only places are held in arrays; rows are
sorted, and a sort can spill. The order of arrival does not matter, so a
repeated task, or a second run over the same files, writes the same rows in the same order.

Law `rows`: a shard is a run of the whole shuffled order, so counts are at most one apart, slots have no
gaps, and a bucket's task writes its rows straight into the one or two shards it lies in (or more, if shards
are smaller than buckets).

Cases: a null text has no bytes and checksum 0; null ids and repeated rows are ordinary rows; an
empty table gives an empty result; other columns pass unchanged, but for shard and slot, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_path

BUCKET_BYTES = 16 << 20
MAX_BUCKETS = 1 << 20  # rows of the table of buckets, which is broadcast; beyond 16 TB buckets grow instead
SEED = 20240501


def assign_shards(docs: DataFrame, shards: int = 24, text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, seed: int = SEED, path: str | None = None) -> DataFrame:
    """docs with shard and slot, as written to `path`, a folder a shard: a uniform shuffle whose shards differ by one row at most.

    docs: a scan of files, so that a row's place stays the same if a task is repeated.
    """
    spark, docs = docs.sparkSession, docs.drop("shard", "slot")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 64
    total, n = docs.agg(F.coalesce(F.sum(size), F.lit(0)), F.count(F.lit(1))).first()
    buckets = min(MAX_BUCKETS, max(1, -(-int(total) // bucket_bytes)))
    placed = docs.select(F.monotonically_increasing_id().alias("place"), F.struct(*docs.columns).alias("row"))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("place", F.lit(seed)), F.lit(buckets)).cast("int"))
    # one row a bucket: where it begins in the whole order
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("before"))
    # the order of a bucket by its places alone, dealt like the rows, so that rows meet their ranks in the bucket's task
    order = placed.select("bucket", "place").repartitionById(buckets, "bucket").groupBy("bucket").agg(F.shuffle(F.array_sort(F.collect_list("place")), seed).alias("places"))
    ranks = order.join(F.broadcast(before), "bucket").select("bucket", "before", F.posexplode("places").alias("pos", "place"))
    ranks = ranks.select("bucket", "place", (F.col("before") + F.col("pos")).alias("rank"))
    dealt = placed.repartitionById(buckets, "bucket").join(ranks.hint("shuffle_hash"), ["bucket", "place"], "left")
    rank = F.coalesce("rank", F.raise_error(F.lit("a row has changed its place: docs must be a scan of files")).cast("long"))
    out = dealt.select("row.*", rank.alias("slot")).withColumn("shard", F.expr(f"cast(slot * {shards} div {max(n, 1)} as int)"))
    out = out.withColumn("slot", F.col("slot") - F.expr(f"(cast(shard as bigint) * {n} + {shards - 1}) div {shards}"))  # less the rank at which the shard begins
    out = out.select(*docs.columns, "shard", "slot").sortWithinPartitions("shard", "slot")
    path = path or fresh_path(spark, "shards")
    out.write.mode("overwrite").partitionBy("shard").parquet(path)
    back = spark.read.schema(out.schema).parquet(path)
    return back.select(*docs.columns, F.col("shard").cast("int").alias("shard"), "slot")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    # measured before the shuffle, so that texts are written with their shard but not read again for the digest
    docs = docs.withColumns({"size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8, "text_crc32": F.coalesce(F.crc32("text"), F.lit(0)).cast("long")})
    return assign_shards(docs, 24).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))
