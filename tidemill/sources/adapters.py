"""The benchmark tables as event, catalog and profile tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import epoch_ms
from ..functions.schema import conform

TYPES = {"view": "EVENT_TYPE_VIEW", "click": "EVENT_TYPE_CLICK", "purchase": "EVENT_TYPE_ACTION", "error": "EVENT_TYPE_NEGATIVE", "signup": "EVENT_TYPE_IMPRESSION"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])[F.col("event_type")]
    session = F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMdd"))
    return e.select(
        F.col("user_id").cast("string").alias("user_id"), k.cast("string").alias("experience_id"), F.col("event_id").cast("string").alias("event_id"), kind.alias("event_type"),
        F.when(F.col("event_id") % 2 == 0, session).alias("request_id"), session.alias("session_id"), (k % 50).alias("position"), F.col("ts").cast("timestamp_ntz").alias("event_timestamp"),
        F.round(F.col("value") * 100).cast("bigint").alias("view_data_dwell_time_ms"), F.concat(F.lit("p"), (F.col("event_id") % 3).cast("string")).alias("device_context_platform"),
        F.lit("1.0").alias("device_context_app_version"), F.lit(100).alias("device_context_screen_width"), F.lit(200).alias("device_context_screen_height"), F.lit("recommendation_feedback_v1").alias("partition_event_type"),
    )


def served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request a user and day: distinct experiences in order of first appearance."""
    f = feedback(spark, sf_dir)
    firsts = f.groupBy("user_id", "session_id", "experience_id").agg(F.min("event_timestamp").alias("t"))
    items = F.array_sort(F.collect_list(F.struct("t", F.col("experience_id").cast("int").alias("k"))))
    out = firsts.groupBy("user_id", "session_id").agg(items.alias("x"), F.min("t").alias("event_timestamp"))
    return out.select(F.col("session_id").alias("request_id"), "user_id", "session_id", "event_timestamp", F.lit("home").alias("trigger"), F.lit("r1").alias("retrieval_model"), F.lit("k1").alias("ranking_model"), F.transform("x", lambda i: F.struct(i["k"].cast("string").alias("event_id"), F.lit(0.5).cast("float").alias("ranking_score"))).alias("recommendations"))


def experiences(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    day = 86_400_000
    start = F.lit(1706572800000) + (k % 21 - 7) * day
    return conform(p.select(
        k.cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_name").alias("description"), F.col("p_brand").alias("category_id"), F.col("p_type").alias("category_name"),
        ((k % 1800) / 10 - 90).alias("event_location_latitude"), ((k % 3600) / 10 - 180).alias("event_location_longitude"), F.concat(F.lit("C"), (k % 25).cast("string")).alias("event_location_city"),
        F.col("p_retailprice").alias("price_amount"), F.lit(1).alias("price_currency"), start.alias("start_time"), (start + (k % 5) * 3_600_000).alias("end_time"), F.col("p_size").alias("bucket_size"), (k % 4).cast("int").alias("total_buckets"),
        F.transform(F.split("p_name", " "), lambda t: F.struct(t.alias("id"), t.alias("name"))).alias("tags"), (F.lit(1706572800000) - (k % 90) * day).alias("created_at"), (F.lit(1706572800000) - (k % 30) * day).alias("updated_at"),
    ), "experience")


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, k = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"), F.col("c_custkey")
    day = 86_400_000
    return conform(c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        k.cast("string").alias("id"), (k % 3).cast("int").alias("gender"), F.floor(F.col("c_acctbal") / 1000).cast("int").alias("social_score"), (k % 3).cast("int").alias("on_boarding_status"), F.col("n_name").alias("current_address_city"),
        ((k % 1790) / 10 - 89).alias("current_address_latitude"), ((k % 3590) / 10 - 179).alias("current_address_longitude"), F.array(F.struct(F.lower("c_mktsegment").alias("id"), F.col("c_mktsegment").alias("name"))).alias("interests"),
        (F.lit(1706572800000) - (k % 40) * day).alias("created_at"), F.lit(1706572800000).alias("updated_at"),
    ), "user_profile")


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON messages (value, topic, partition, offset)."""
    e = table(spark, sf_dir, "events")
    ms = epoch_ms(F.col("ts"))
    k = F.get_json_object("props", "$.k").cast("int")
    body = F.to_json(F.struct(F.lit("engagement.v1").alias("_event_type"), ms.cast("string").alias("_timestamp"), F.col("user_id").cast("string").alias("user_id"), F.col("event_type"), ms.cast("string").alias("timestamp"), (k % 90).cast("double").alias("latitude"), (k % 180).cast("double").alias("longitude"), F.concat(F.lit("cat"), (k % 7).cast("string")).alias("category_name"), F.array(F.concat(F.lit("t"), (k % 13).cast("string"))).alias("tags"), k.cast("string").alias("experience_id")))
    return e.select(body.alias("value"), F.lit("events.raw").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"))


def app_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog, profile, location and feedback messages (value, topic, partition, offset), some with faults; accounts, which are skipped."""
    p, c, e, s = (table(spark, sf_dir, n) for n in ("part", "customer", "events", "supplier"))
    text = lambda *cols: F.to_json(F.struct(*cols))
    k, u, n = F.col("p_partkey"), F.col("c_custkey"), F.col("event_id")
    place = F.struct(F.concat(F.lit("C"), (k % 25).cast("string")).alias("city"), F.struct(((k % 1800) / 10 - 90).alias("latitude"), ((k % 3600) / 10 - 180).alias("longitude")).alias("coordinate"), F.lit("x").alias("street"))
    items = text(
        F.when(k % 3 != 0, F.lit("experience.v1.ExperienceCreated")).alias("_event_type"), F.when(k % 17 != 0, k.cast("string")).alias("id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("priceAmount"), F.lit("secret").alias("internalNote"), place.alias("eventLocation"),
        F.transform(F.split("p_name", " "), lambda t: F.struct(t.alias("id"), t.alias("name"), F.lit(1).alias("rank"))).alias("tags"), F.struct(F.col("p_brand").alias("id"), F.col("p_type").alias("name")).alias("category"),
    )
    people = text(F.lit("user.v1.UserProfileUpdated").alias("_event_type"), F.when(u % 7 != 0, u.cast("string")).alias("id"), F.lit("secret").alias("phone"), F.array().cast("array<string>").alias("interests"))
    places = text(F.col("user_id").cast("string").alias("user_id"), F.when(n % 25 != 0, n % 110).alias("latitude"), F.lit(7.5).alias("longitude"))
    acts = text(F.lit("feed.v1.RecommendationFeedback").alias("_event_type"), F.when(n % 7 == 1, "").otherwise(F.col("user_id").cast("string")).alias("user_id"), F.when(n % 11 != 0, n.cast("string")).alias("event_id"), F.lit("t").alias("_trace_id"), F.struct((n % 9).alias("dwell_time_ms")).alias("view_data"))
    message = lambda df, value, topic, offset: df.select(value.alias("value"), F.lit(topic).alias("topic"), F.lit(0).alias("partition"), offset.cast("bigint").alias("offset"))
    parts = [
        message(p, items, "experience.events", k), message(c, people, "user.profile.events", u), message(e.filter(n % 5 == 0), places, "location.streams", n), message(e.filter(n % 5 != 0), acts, "recommendation.feedback.v1", n),
        message(s, F.lit("{}"), "user.account.events", F.col("s_suppkey")),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out
