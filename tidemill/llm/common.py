"""Helpers that several operators share: the shared folder, salted joins, bounded bitmaps, components, text batches."""

from __future__ import annotations

import atexit
import ctypes
import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SALTS = 16
HOT_KEYS = 2048  # the most rows that counted_join() broadcasts
# Rows of a bitmap are 4 KiB, 4,224 bytes in the table that Spark's driver builds of them; that table's memory is doubled
# whenever it is full, so both sizes stay just under a power of two.
BITMAP_BITS = 248 << 15  # what a bounded bitmap broadcasts never exceeds 1 MiB
WIDE_BITS = 1984 << 15  # 8 MiB
BROADCAST_BYTES = 8 << 20  # of rows that Spark may broadcast in a join, as they are in memory


# ---------------------------------------------------------------- shared folder
def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir). Only a local master may fall back to a temporary one."""
    conf = spark.sparkContext.getConf()
    if found := conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="tidemill-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    except Exception:  # the session has gone: its folder is the cluster's to clean
        return


def fresh_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/tidemill/{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, tag)
    df.write.mode("overwrite").parquet(path)
    relieve_driver(df.sparkSession)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def relieve_driver(spark: SparkSession, share: float = 0.25) -> None:
    """Runs the driver's collector once more than this share of its heap is in use.

    What jobs leave behind (broadcasts, results, plans) is else kept until the heap has grown to its limit, and
    executors keep their copies of a broadcast until the driver's has been collected.
    """
    run = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    if run.totalMemory() - run.freeMemory() > share * run.maxMemory():
        spark.sparkContext._jvm.System.gc()


def discard(*written: DataFrame) -> None:
    """Deletes tables of materialize() that nothing reads any more; the rest go when the session ends.

    Spark deletes shuffle files of finished jobs once the driver's collector has found them unused, so it is run here.
    """
    for df in written:
        _remove(df.sparkSession, df.written_at)
    if written:
        written[0].sparkSession.sparkContext._jvm.System.gc()


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of df has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


# ---------------------------------------------------------------- joins
def is_small(rows: int, copies: int = 1, payload: int = 0) -> bool:
    """Whether so many rows of a few numbers, with so many bytes besides, can be broadcast without harm to the driver."""
    return copies * (64 * rows + payload) <= BROADCAST_BYTES


def sized(written: DataFrame, copies: int = 1, payload: str | None = None) -> DataFrame:
    """A written table as a side of a join, `copies` times: what is not small in memory is merged, whatever its files' size.

    Spark judges by the bytes of the files, compressed and before rows are repeated, which can be a hundredth
    of what the driver then has to hold; and it does not go back on a broadcast that it has planned.
    """
    rows, more = written.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(payload)), F.lit(0)) if payload else F.lit(0)).first()
    return written if is_small(rows, copies, more) else written.hint("merge")


def salted_left_join(left: DataFrame, groups: DataFrame, keys: list[str], salt_by: Column, salts: int = SALTS) -> DataFrame:
    """left LEFT JOIN groups (one row a key), with a hot key of `left` spread over `salts` tasks.

    The right side is repeated once a salt, so it should hold groups only, not rows.
    """
    (salt,) = free_names(left, "_salt")
    spread = groups.withColumn(salt, F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return left.withColumn(salt, F.pmod(salt_by, F.lit(salts)).cast("int")).join(spread, [*keys, salt], "left").drop(salt)


def counted_join(left: DataFrame, groups: DataFrame, key: str, count: str, total: int, salt_by: Column, hot: int = HOT_KEYS, salts: int = 64) -> DataFrame:
    """left JOIN groups (a written table: one row a key, with the number of its rows in `left`), however the rows are spread over the keys.

    A key of more than total / hot rows is hot. There are fewer than `hot` of them, so they can be broadcast
    to mark their rows, which are then dealt over `salts` tasks; no other key can fill a task.
    """
    (mark, salt) = free_names(left, "_hot", "_salt")
    is_hot = F.col(count) > max(1, total // hot)
    some = F.broadcast(groups.filter(is_hot).select(key, F.lit(True).alias(mark)))
    dealt = left.join(some, key, "left").withColumn(salt, F.when(F.col(mark), F.pmod(salt_by, F.lit(salts)).cast("int")).otherwise(0)).drop(mark)
    spread = sized(groups).withColumn(salt, F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(spread, [key, salt]).drop(salt)


_AS_LONGS = "transform(sequence(0, 511), i -> cast(conv(hex(substring(map, i * 8 + 1, 8)), 16, -10) as bigint))"


def bitmap_of(keys: DataFrame, h: Column, bits: int = BITMAP_BITS) -> DataFrame:
    """A bitmap of hashed keys as at most bits/32768 rows of 4 KiB, built by partial aggregation."""
    at = F.pmod(h, F.lit(bits)) + 1
    return keys.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map")).select("bucket", F.expr(_AS_LONGS).alias("map"))


def marked(df: DataFrame, h: Column, bitmap: DataFrame, name: str, bits: int = BITMAP_BITS) -> DataFrame:
    """df with a column that tells whether a row's hash may be among the keys of the bitmap: false is certain.

    The broadcast side has a proven bound (bits / 8 bytes).
    """
    at, bucket, map_ = free_names(df, "_at", "_bucket", "_map")
    both = df.withColumn(at, F.pmod(h, F.lit(bits))).join(F.broadcast(bitmap.withColumnsRenamed({"bucket": bucket, "map": map_})), F.expr(f"1 + {at} div 32768") == F.col(bucket), "left")
    place = f"({at} % 32768)"
    bit = F.expr(f"getbit({map_}[cast({place} div 64 as int)], cast((7 - {place} div 8 % 8) * 8 + {place} % 8 as int))")
    return both.withColumn(name, F.coalesce(bit == 1, F.lit(False))).drop(at, bucket, map_)


def maybe_in(df: DataFrame, h: Column, bitmap: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """Rows of df whose hash may be among the keys of the bitmap: no key is missed, so an exact join may follow.

    When the keys fill the bitmap every row passes and the exact join does all the work.
    """
    (name,) = free_names(df, "_maybe")
    return marked(df, h, bitmap, name, bits).filter(F.col(name)).drop(name)


def without(df: DataFrame, lost: DataFrame, key: str, bits: int = BITMAP_BITS) -> DataFrame:
    """df without the rows whose key is in lost (a written table of keys). Rows that the bitmap clears stay in their task; the others meet lost in an exact join. A null key stays."""
    (name,) = free_names(df, "_maybe")
    rows = marked(df, F.xxhash64(key), bitmap_of(lost, F.xxhash64(key), bits), name, bits)
    stay, maybe = rows.filter(~F.col(name)).drop(name), rows.filter(F.col(name)).drop(name)
    return stay.unionByName(maybe.join(sized(lost).select(key), key, "left_anti"))


def components(edges: DataFrame, tag: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a, b); component is its smallest reachable node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014); each round is one
    written table, nothing is collected but a checksum.
    """
    cur = materialize(edges.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).filter("u <> v").distinct(), f"{tag}-cc")
    seen, edges_now = None, cur.count()
    for _ in range(max_rounds):
        merged = (lambda df: df) if is_small(2 * edges_now) else (lambda df: df.hint("merge"))
        both = cur.unionByName(cur.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(merged(low), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # every edge now has u > v: the small star keeps the lowest neighbour of each u
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(merged(low), "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct()
        cur = materialize(small, f"{tag}-cc")
        now = tuple(cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            break
        seen, edges_now = now, now[0]
    else:
        raise RuntimeError("components did not settle")
    return cur.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


# ---------------------------------------------------------------- samples
def in_sample(key: Column, wanted: int, total: int) -> Column:
    """Whether a row belongs to a sample of about `wanted` of `total` rows, by a hash of its key; all rows if there are not more."""
    share = min(1.0, wanted / max(total, 1))
    return F.shiftrightunsigned(F.xxhash64(key), 1) <= F.lit(max(0, int(share * (1 << 63)) - 1)).cast("long")


# ---------------------------------------------------------------- text batches
def release_memory() -> None:
    """Hands what this process has freed back to the system: Arrow's pool and the C library keep it else."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library than glibc
        pass


def released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that releases its process's memory when a task ends: Spark keeps the process for later tasks, beside those of other stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release_memory()

    return run


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column without nulls and in one piece."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that the texts of each hold at most `limit` bytes (or one row): bounds a task's memory."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(sizes.tolist()):
            if total + size > limit and i > start:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (one more offset at the end)."""
    arr = texts_of(column)
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the byte spans data[start:end], equal for equal spans wherever they stand.

    Eight bytes at a time pass through the finaliser of a state that begins with seed and length, so
    no regular pattern of bytes cancels out, as it does in a polynomial; a secret seed
    hides the state from whoever writes the texts.
    """
    size = ends - starts
    h = mix(size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))
    if not len(starts):
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ascontiguousarray(np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,)))
    h = mix(h ^ (eight[np.minimum(starts, len(data))] & _MASK[np.minimum(size, 8)]))
    long, step = np.flatnonzero(size > 8), 8
    while len(long):
        if step > 256:  # a few very long spans: by a hash of the library, so that none takes thousands of steps
            for k in long.tolist():
                digest = hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8, key=int(seed).to_bytes(8, "little")).digest()
                h[k] = np.frombuffer(digest, np.uint64)[0]
            break
        h[long] = mix(h[long] ^ (eight[starts[long] + step] & _MASK[np.minimum(size[long] - step, 8)]))
        step += 8
        long = long[size[long] > step]
    return h


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ of texts that stand one after another, and how many words come before each text."""
    inside = ~((data == 0x20) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, inside
    here = np.append(inside, False)
    starts = np.flatnonzero(here & (~before | edge))
    ends = np.flatnonzero(before & (~here | edge))
    return starts, ends, np.searchsorted(starts, at)


def sorted_unique(x: np.ndarray) -> np.ndarray:
    """Like np.unique, by a plain sort (quicker than hashing for integers)."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all else as it is."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
