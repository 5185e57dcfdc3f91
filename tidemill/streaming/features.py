"""Windowed user features on streams (or on a batch: the same plan).

Windows are event-time windows with a watermark: tumbling (30 s by default) or session windows
(30 min gap). Events later than the watermark are dropped. Lists are sorted by time inside the
aggregate, so results do not depend on arrival order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import OTHER_STREAM_WEIGHT, STREAM_WEIGHTS, epoch_ms, haversine, last_distinct, lookup, parse_time
from ..operators.quality import event_error
from ..sources.envelope import dead_letters, message_id, parse
from ..sources.stores import TableStore, as_entries

WATERMARK = "1 minute"
# Lengths of the lists.
LISTS = {"categories": 5, "tags": 10, "experiences": 50}
MOVED_M = 100.0


def event_time(df: DataFrame) -> Column:
    """An instant (watermarks need one) that does not depend on the session's zone."""
    said = F.coalesce(*[parse_time(F.col(c)) for c in ("_timestamp", "timestamp", "created_at") if c in df.columns])
    return F.timestamp_millis(epoch_ms(said))


def user_of(df: DataFrame) -> Column:
    has = lambda c: F.when(F.trim(F.col(c)) != "", F.col(c)) if c.strip("`") in df.columns else F.lit(None).cast("string")
    own = F.when(F.col("_event_type").startswith("user.") | F.col("_event_type").contains("AccountCreated"), has("id"))
    # last resort: fields that carry only their tag's number, or an id that looks like a user's
    guess = [F.when(has(c).startswith("user") | (F.length(has(c)) >= 20), has(c)) for c in ("`2`", "`1`", "id") if c.strip("`") in df.columns]
    return F.coalesce(has("userId"), has("user_id"), own, *guess)


def parse_events(messages: DataFrame) -> DataFrame:
    """Messages as typed events with event_timestamp, user_id and error_type (null when valid)."""
    df = parse(messages)
    # an empty user_id is a fault of its own, so the field as it came is judged before the user is resolved
    df = df.withColumn("_fault", F.coalesce("_parse_error", event_error(df, F.coalesce("topic", F.lit("events.raw")), {"user_id": F.coalesce("user_id", user_of(df))})))
    degrees = {c: F.col(c).try_cast("double") for c in ("latitude", "longitude")}
    df = df.withColumns(degrees | {"user_id": user_of(df), "session_id": F.coalesce("session_id", "sessionId"), "experience_id": F.coalesce("experience_id", "experienceId"), "category_name": F.coalesce("category_name", "category"), "event_timestamp": event_time(df)})
    return df.withColumn("error_type", F.coalesce("_fault", F.when(F.col("event_timestamp").isNull(), "invalid_timestamp"))).drop("_fault")


def split_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid events, dead letters)."""
    bad = events.filter("error_type IS NOT NULL")
    return events.filter("error_type IS NULL"), dead_letters(bad, F.col("error_type"))


def deduplicate(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """One row a message id. On a stream ids are remembered for the watermark's delay."""
    own = events.withColumn("message_id", message_id(F.col("topic"), F.col("partition"), F.col("offset"), F.coalesce("_timestamp", "timestamp")))
    return own.withWatermark("event_timestamp", watermark).dropDuplicatesWithinWatermark(["message_id"]) if events.isStreaming else own.dropDuplicates(["message_id"])


def event_name(df: DataFrame) -> Column:
    """The inner event type; where it says nothing, the last part of the message's name."""
    inner = F.when(~F.lower(F.trim("event_type")).isin("", "unknown"), F.lower("event_type"))
    return F.coalesce(inner, F.lower(F.substring_index("_event_type", ".", -1)), F.lit("unknown"))


def event_weight(name: Column) -> Column:
    """A feedback message counts by the action in its inner type."""
    inner = F.lower(F.coalesce("event_type", F.lit("")))
    feedback = F.when(inner.contains("view"), 1.0).when(inner.contains("click"), 2.0).otherwise(OTHER_STREAM_WEIGHT)
    return F.when(name.contains("feedback"), feedback).otherwise(lookup(name, STREAM_WEIGHTS, OTHER_STREAM_WEIGHT))


def windowed(events: DataFrame, window: Column, watermark: str | None = None) -> DataFrame:
    """Session and real-time features of each user and window. watermark: for a stream that has none yet (deduplicate() sets one)."""
    name = event_name(events)
    row = F.struct(F.col("event_timestamp").alias("ts"), name.alias("name"), event_weight(name).alias("weight"), "latitude", "longitude", F.col("category_name").alias("category"), "tags", "experience_id", "session_id", F.col("_event_type").alias("kind"), "recommendations")
    base = events.withWatermark("event_timestamp", watermark) if events.isStreaming and watermark else events
    grouped = base.groupBy(F.coalesce("user_id", F.lit("unknown")).alias("user_id"), window.alias("w")).agg(F.array_sort(F.collect_list(row)).alias("e"))
    return grouped.select("user_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *_features(F.col("e")))


def location_changes(located: Column) -> Column:
    """Moves of more than 100 m between consecutive located events."""
    move = lambda a, b: (haversine(a["latitude"], a["longitude"], b["latitude"], b["longitude"], 6_371_000.0) > MOVED_M).cast("int")
    pairs = F.zip_with(F.slice(located, 1, F.greatest(F.size(located) - 1, F.lit(0))), F.slice(located, 2, F.greatest(F.size(located) - 1, F.lit(0))), move)
    return F.aggregate(pairs, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))


def _features(e: Column) -> list[Column]:
    first, last = F.element_at(e, 1), F.element_at(e, -1)
    names = F.transform(e, lambda x: x["name"])
    located = F.filter(e, lambda x: x["latitude"].isNotNull() & x["longitude"].isNotNull())
    place = F.try_element_at(located, F.lit(-1))
    cats = F.array_compact(F.transform(e, lambda x: F.when(x["category"] != "", x["category"])))
    kinds = F.array_distinct(cats)
    counted = F.array_sort(F.transform(kinds, lambda c, i: F.struct((-F.size(F.filter(cats, lambda x: x == c))).alias("n"), i.alias("i"), c.alias("c"))))
    tags = F.flatten(F.transform(e, lambda x: F.coalesce(x["tags"], F.array().cast("array<string>"))))
    shown = F.flatten(F.transform(F.filter(e, lambda x: F.lower(x["kind"]).contains("served")), lambda x: F.transform(F.coalesce(x["recommendations"], F.array().cast("array<struct<event_id:string,experience_id:string>>")), lambda r: F.coalesce(r["event_id"], r["experience_id"]))))
    score = F.round(F.least(F.aggregate(e, F.lit(0.0), lambda s, x: s + x["weight"]) / (5 * F.size(e)), F.lit(1.0)), 4)
    session = F.coalesce(first["session_id"], F.substring(F.md5(F.concat_ws(":", first["ts"].cast("string"), first["kind"])), 1, 12))
    return [
        session.alias("session_id"), first["ts"].alias("session_start"), last["ts"].alias("session_end"), (F.timestamp_diff("MICROSECOND", first["ts"], last["ts"]) / 1e6).alias("session_duration_seconds"), F.size(e).alias("activity_count"),
        F.size(F.array_distinct(names)).alias("unique_event_types"), F.map_from_entries(F.transform(F.array_distinct(names), lambda n: F.struct(n, F.size(F.filter(names, lambda x: x == n))))).alias("event_type_counts"), last["name"].alias("last_event_type"),
        location_changes(located).alias("location_changes"), place["latitude"].alias("last_latitude"), place["longitude"].alias("last_longitude"), score.alias("engagement_score"),
        last_distinct(cats, LISTS["categories"]).alias("recent_categories_viewed"), last_distinct(tags, LISTS["tags"]).alias("recent_tags_interacted"), F.coalesce(F.try_element_at(counted, F.lit(1))["c"], F.lit("")).alias("session_category_focus"),
        last_distinct(F.transform(e, lambda x: x["experience_id"]), LISTS["experiences"]).alias("user_viewed_experiences"), F.array_compact(F.array_distinct(shown)).alias("already_shown_session"),
    ]


def tumbling(events: DataFrame, seconds: int = 30, watermark: str | None = None) -> DataFrame:
    return windowed(events, F.window("event_timestamp", f"{seconds} seconds"), watermark)


def sessions(events: DataFrame, gap: str = "30 minutes", watermark: str | None = None) -> DataFrame:
    return windowed(events, F.session_window("event_timestamp", gap), watermark)


def invalid_counts(events: DataFrame) -> DataFrame:
    """Running count of invalid events by user (complete or update mode)."""
    return events.groupBy(F.coalesce("user_id", F.lit("unknown")).alias("user_id")).agg(F.count_if(F.col("error_type").isNotNull()).alias("invalid_events"), F.count(F.lit(1)).alias("events"))


def upsert_online(store: TableStore, prefix: str = "realtime:user", ttl_seconds: int = 3600) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: the newest window of each user goes to the store if its content changed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = batch.groupBy("user_id").agg(F.max_by(F.struct(*[c for c in batch.columns if c != "user_id"]), "window_start").alias("x")).select("user_id", "x.*")
        store.upsert(as_entries(newest, "user_id", prefix), batch_id, ttl_seconds)

    return write


def start(features: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False, every: str = "30 seconds"):
    """The running query; once processes what is there and stops."""
    writer = features.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def archive(events: DataFrame, root: str, checkpoint: str, once: bool = False, every: str = "60 seconds"):
    """The event lake as a streaming sink, partitioned by type and event time of each row, then by batch: a batch that is
    replayed replaces its own files. The root belongs to this stream alone, as its folders go one level deeper."""
    from ..sources.lake import write_events

    writer = events.writeStream.foreachBatch(lambda df, n: write_events(df, root, mode="overwrite", batch=n)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def kafka_source(spark, servers: str, topics: list[str], options: dict[str, str] | None = None) -> DataFrame:
    """Messages of several topics from the latest offsets. Needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics)).option("startingOffsets", "latest")
    return reader.options(**(options or {})).load()
