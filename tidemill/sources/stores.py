"""Feature sinks: offline tables by date, dead letters, and a key-value store written from the executors."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KV = "key string, value map<string,string>, digest string, expires_at timestamp"


def prepare_offline(df: DataFrame, legacy_format: bool = False) -> DataFrame:
    """legacy_format: arrays as comma strings and event_timestamp as a date, else native types."""
    if not legacy_format:
        return df
    out = df.withColumn("event_timestamp", F.to_date("event_timestamp")) if "event_timestamp" in df.columns else df
    return out.withColumns({f.name: F.concat_ws(",", f.name) for f in df.schema if isinstance(f.dataType, T.ArrayType)})


def write_offline(df: DataFrame, path: str, on: date, legacy_format: bool = False, replace_all: bool = False) -> None:
    """Replaces the rows of one date and leaves other dates alone, so a rerun changes nothing. replace_all: the other dates go."""
    out = prepare_offline(df, legacy_format).withColumn("date", F.lit(on))
    out.write.mode("overwrite").option("partitionOverwriteMode", "static" if replace_all else "dynamic").partitionBy("date").parquet(path)


def write_training_set(df: DataFrame, base: str, model: str, on: date) -> None:
    df.write.mode("overwrite").parquet(f"{base}/{model}/date={on.isoformat()}")


def write_dead_letters(df: DataFrame, base: str, entity: str, reason: str, batch: str) -> None:
    df.withColumn("error_reason", F.lit(reason)).write.mode("append").parquet(f"{base}/{entity}/{reason}/{batch}")


def latest_per_key(df: DataFrame, key: str, ts: str = "event_timestamp") -> DataFrame:
    """One row a key: the latest, ties by the whole row."""
    order = Window.partitionBy(key).orderBy(F.col(ts).desc_nulls_last(), F.xxhash64(*df.columns))
    return df.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def as_entries(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """(key, value, digest): non-null columns as strings, arrays joined by commas."""
    text = lambda f: F.concat_ws(",", f.name) if isinstance(f.dataType, T.ArrayType) else F.to_json(f.name) if isinstance(f.dataType, (T.MapType, T.StructType)) else F.col(f.name).cast("string")
    pairs = F.map_from_arrays(F.array(*[F.lit(f.name) for f in df.schema]), F.array(*[text(f) for f in df.schema]))
    value = F.map_filter(pairs, lambda k, v: v.isNotNull())
    return df.filter(F.col(key).isNotNull()).select(F.concat(F.lit(f"{prefix}:"), F.col(key).cast("string")).alias("key"), value.alias("value")).withColumn("digest", content_hash("value"))


# Fields that say when, not what.
NOT_CONTENT = ["_hash", "updated_at", "created_at", "timestamp"]


def content_hash(value: str) -> Column:
    said = F.map_filter(value, lambda k, v: ~k.isin(NOT_CONTENT))
    return F.md5(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(said)))))


def changed(entries: DataFrame, stored: DataFrame) -> DataFrame:
    """Entries whose content differs from what is stored under their key."""
    return entries.join(stored.select("key", "digest"), ["key", "digest"], "left_anti")


class TableStore:
    """A key-value store as a table: every write adds a version, reads take the newest that has not expired."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _versions(self) -> DataFrame:
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], KV + ", version bigint")

    def current(self, now: Column | None = None) -> DataFrame:
        rows = self._versions()
        newest = rows.groupBy("key").agg(F.max_by(F.struct("value", "digest", "expires_at"), "version").alias("x")).select("key", "x.*")
        return newest.filter(F.col("value").isNotNull() & (F.col("expires_at") > (F.current_timestamp() if now is None else now)))

    def upsert(self, entries: DataFrame, version: int, ttl_seconds: int, only_changed: bool = True) -> None:
        """Idempotent for a version: a replayed batch writes the same rows over itself."""
        new = changed(entries, self.current()) if only_changed else entries
        out = new.select("key", "value", "digest", (F.current_timestamp() + F.make_dt_interval(secs=F.lit(ttl_seconds))).alias("expires_at"), F.lit(version).cast("bigint").alias("version"), F.lit(version).alias("batch"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.path)

    def delete(self, keys: DataFrame, version: int) -> None:
        gone = keys.select("key", F.lit(None).cast("map<string,string>").alias("value"), F.lit(None).cast("string").alias("digest"))
        self.upsert(gone, version, 0, only_changed=False)

    def compact(self) -> None:
        """The newest version of each key (deleted and expired ones too, so that none comes back) in one batch; older batches go.

        One writer at a time. If it is cut short, what is left twice is the same version of the same key.
        """
        rows = self._versions()
        last = rows.agg(F.max("version")).first()[0]
        if last is None:
            return
        newest = rows.groupBy("key").agg(F.max_by(F.struct("value", "digest", "expires_at", "version"), "version").alias("x")).select("key", "x.*")
        done = -1 - last
        old = [r[0] for r in rows.select("batch").distinct().collect() if r[0] != done]  # batches, not keys
        if not old:
            return
        newest.withColumn("batch", F.lit(done).cast("bigint")).write.mode("append").partitionBy("batch").parquet(self.path)
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for b in old:
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch={b}")
            folder.getFileSystem(conf).delete(folder, True)

    def get(self, key: str) -> dict[str, str] | None:
        row = self.current().filter(F.col("key") == key).first()
        return dict(row.value) if row else None

    def count(self, prefix: str) -> int:
        return self.current().filter(F.col("key").startswith(prefix) & (F.size("value") > 0)).count()


def write_online(df: DataFrame, key: str, prefix: str, put: Callable[[list[tuple[str, dict[str, str], int]]], None], ttl_seconds: int = 7 * 86400, batch: int = 500) -> None:
    """Latest row of each key to a store of your own, from the executors. put gets (key, fields, ttl) in batches."""
    entries = as_entries(latest_per_key(df, key), key, prefix).select("key", "value")

    def send(rows) -> None:
        held = []
        for r in rows:
            held.append((r.key, dict(r.value), ttl_seconds))
            if len(held) == batch:
                put(held)
                held = []
        if held:
            put(held)

    entries.foreachPartition(send)


def materialize_range(features: DataFrame, key: str, prefix: str, start: date, end: date, store: TableStore, version: int, ttl_seconds: int = 7 * 86400) -> None:
    """Offline to online: the latest row of each key within [start, end]."""
    rows = features.filter((F.to_date("event_timestamp") >= F.lit(start)) & (F.to_date("event_timestamp") <= F.lit(end)))
    store.upsert(as_entries(latest_per_key(rows, key), key, prefix), version, ttl_seconds)


def embedding_text(vector: Column) -> Column:
    return F.concat_ws(",", F.transform(vector, lambda x: x.cast("string")))


def embedding_of(text: Column) -> Column:
    return F.split(text, ",").cast("array<double>")
