"""The registered queries over the benchmark tables."""

from __future__ import annotations

import tempfile
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import epoch_ms, position_features, top_k_elements
from ..operators import asof, features, quality, training
from ..sources import adapters as src
from ..sources.envelope import message_id
from ..sources.lake import EventLake, catalog_rows, profile_rows, write_events
from ..sources.stores import as_entries, changed
from ..streaming import features as stream
from ..streaming import routing

D = date(2024, 1, 30)
NOW = "2024-01-31 00:00:00"


def flat(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable columns: doubles rounded, arrays joined, times as milliseconds."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws("|", c)
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = epoch_ms(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def user_engagement_raw(s, d):
    return flat(features.user_engagement(src.feedback(s, d), D))


def user_engagement_smoothed(s, d):
    return flat(features.user_engagement(src.feedback(s, d), D, smoothed=True))


def experience_engagement_raw(s, d):
    return flat(features.experience_engagement(src.feedback(s, d), D))


def experience_engagement_smoothed(s, d):
    return flat(features.experience_engagement(src.feedback(s, d), D, smoothed=True))


def session_features(s, d):
    located = src.feedback(s, d).withColumn("city", F.concat(F.lit("c"), (F.col("position") % 3).cast("string")))
    return flat(features.session_features(located, D, city="city"))


def user_top_categories(s, d):
    return flat(features.top_categories(src.feedback(s, d), src.experiences(s, d), D))


def latest_profile(s, d):
    rows = src.feedback(s, d).select("user_id", "event_id", "event_type", "event_timestamp")
    return flat(features.latest_row(rows, "user_id", "event_timestamp"))


def latest_content(s, d):
    rows = src.feedback(s, d).select("experience_id", "event_id", "user_id", "event_timestamp")
    return flat(features.latest_row(rows, "experience_id", "event_timestamp"))


def user_features_full(s, d):
    out = features.user_features(src.feedback(s, d), D, src.profiles(s, d), src.experiences(s, d))
    return flat(out.select("user_id", "user_impressions_7d", "user_clicks_30d", "user_ctr_7d", "user_is_cold_start", "user_interests", "user_location_lat", "user_city", "user_top_categories", "is_valid"))


def user_profile(s, d):
    return flat(features.user_profile(src.profiles(s, d), D).drop("user_country"))


def experience_profile(s, d):
    return flat(features.experience_profile(src.experiences(s, d), D).drop("exp_country", "exp_creator_type", "exp_creator_id", "exp_tag_ids", "exp_name"))


def merged_user_features(s, d):
    return flat(features.merged_user_features(src.feedback(s, d), src.profiles(s, d), D).select("user_id", "user_city", "user_is_new", "user_clicks_7d", "user_ctr_7d", "user_is_cold_start"))


def merged_experience_features(s, d):
    return flat(features.merged_experience_features(src.feedback(s, d), src.experiences(s, d), D).select("experience_id", "exp_price_tier", "exp_clicks_7d", "exp_ctr_7d", "exp_popularity_tier"))


def training_positives(s, d):
    return flat(training.positives(src.feedback(s, d)))


def training_negatives(s, d):
    return training.negatives(training.positives(src.feedback(s, d)), _items(s, d)).select("user_id", "experience_id", "label")


def _users(s, d):
    return features.user_profile(src.profiles(s, d), D).select("user_id", "user_location_lat", "user_location_lng", "user_city", "user_social_score")


def _items(s, d):
    return features.experience_profile(src.experiences(s, d), D).select("experience_id", "exp_location_lat", "exp_location_lng", "exp_city", "exp_price_tier")


def two_tower(s, d):
    out = training.two_tower(src.feedback(s, d), _users(s, d), _items(s, d), D)
    return flat(out.select("user_id", "experience_id", "label", "engagement_strength", "sample_type", "user_social_score", "exp_price_tier", "cross_distance_km", "cross_same_city"), 3)


def served_exploded(s, d):
    return flat(training.served_items(src.served(s, d)).select("request_id", "position", "experience_id", "ranking_score"))


def _labels(s, d):
    return training.ranking_labels(src.served(s, d), src.feedback(s, d).filter("event_type IN ('EVENT_TYPE_CLICK', 'EVENT_TYPE_VIEW', 'EVENT_TYPE_ACTION')"))


def ranking_labels(s, d):
    return flat(_labels(s, d).select("request_id", "position", "experience_id", "clicked", "acted", "dwell_ms", "label"))


def label_distribution(s, d):
    return training.label_distribution(_labels(s, d))


def ranking_context(s, d):
    out = training.context_features(_labels(s, d), src.feedback(s, d))
    return flat(out.select("request_id", "position", "experience_id", "ctx_platform", "ctx_hour_of_day", "ctx_day_of_week", "ctx_is_weekend", "ctx_time_bucket"))


def ranking_training(s, d):
    out = training.ranking_set(src.served(s, d), src.feedback(s, d).filter("event_type IN ('EVENT_TYPE_CLICK', 'EVENT_TYPE_VIEW', 'EVENT_TYPE_ACTION')"), _users(s, d), _items(s, d), D)
    return flat(out.select("request_id", "experience_id", "position", "label", "position_normalized", "is_top_3", "ctx_hour_of_day", "user_social_score", "exp_price_tier", "cross_distance_km", "cross_distance_bucket"), 3)


def position(s, d):
    rows = src.feedback(s, d).select("event_id", "position")
    return flat(rows.withColumns(position_features(F.col("position"))))


def cross(s, d):
    rows = src.feedback(s, d).select("user_id", "experience_id").distinct()
    return flat(training.cross_features(rows.join(_users(s, d), "user_id", "left").join(_items(s, d), "experience_id", "left")).select("user_id", "experience_id", "cross_distance_km", "cross_distance_bucket", "cross_same_city"), 3)


def pit_join(s, d):
    f = src.feedback(s, d)
    clicks = f.filter("event_type = 'EVENT_TYPE_CLICK'").select("user_id", "event_id", "event_timestamp")
    views = f.filter("event_type = 'EVENT_TYPE_VIEW'").select("user_id", F.col("event_timestamp").alias("ft"), F.col("view_data_dwell_time_ms").alias("dwell"))
    return flat(asof.asof_join(clicks, views, "user_id", "event_timestamp", "ft", timedelta(days=1)).select("event_id", "user_id", "dwell", "feature_timestamp"))


def dq_null_rates(s, d):
    return flat(quality.null_rates(src.feedback(s, d), ["user_id", "request_id", "event_type"]))


def dq_numeric_range(s, d):
    return flat(quality.numeric_ranges(src.table(s, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"]))


def dq_duplicates(s, d):
    return quality.duplicates(src.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_timestamp_validity(s, d):
    return quality.time_validity(src.feedback(s, d), "event_timestamp", F.lit("2024-01-29 00:00:00").cast("timestamp_ntz"))


def dq_split_valid(s, d):
    f = src.feedback(s, d).withColumn("user_id", F.when(F.col("event_id").cast("int") % 7 != 0, F.col("user_id")))
    good, bad = quality.split_valid(f)
    return good.select("event_id", F.lit(True).alias("valid")).unionByName(bad.select("event_id", F.lit(False).alias("valid")))


def dq_flags(s, d):
    p = src.table(s, d, "part")
    checks = {"a": quality.in_range(F.col("p_retailprice"), 950, 1500), "b": quality.string_length(F.col("p_name"), 3, 30), "c": quality.in_enum(F.col("p_brand"), ["Brand#11", "Brand#12", "Brand#21", "Brand#32"]), "e": quality.not_null(F.col("p_size"))}
    return quality.quality_flags(p, checks).select("p_partkey", "is_valid")


def dq_validity_rate(s, d):
    return flat(quality.validity_rate(dq_flags(s, d)))


def dq_skew(s, d):
    return flat(quality.key_skew(src.feedback(s, d), "user_id"))


def dq_freshness(s, d):
    return flat(quality.freshness(src.feedback(s, d), "event_timestamp", now()))


def dq_input_report(s, d):
    return quality.input_report(src.feedback(s, d), ["user_id", "request_id"], "user_id", "event_timestamp", now())


def dq_output(s, d):
    good, _ = quality.validated_output(src.table(s, d, "lineitem").select("l_orderkey", F.col("l_shipdate").alias("event_timestamp")), "l_orderkey")
    return flat(good)


def event_validator(s, d):
    value = F.col("value")
    faults = [
        (11, F.lit("{bad")), (13, F.regexp_replace(value, '"user_id":"[0-9]+"', '"user_id":""')), (17, F.regexp_replace(value, '"user_id":"[0-9]+",', "")), (19, F.regexp_replace(value, '"latitude":[0-9.]+', '"latitude":"abc"')),
        (23, F.regexp_replace(value, '"longitude":[0-9.]+', '"longitude":-180.5')), (29, F.lit("{ }")), (31, F.lit("[1, 2]")), (37, F.regexp_replace(value, '"timestamp":"[0-9]+"', '"timestamp":"soon"')), (41, F.lit(None).cast("string")),
    ]
    said = value
    for n, text in reversed(faults):
        said = F.when(F.col("offset") % n == 0, text).otherwise(said)
    msgs = src.envelopes(s, d).withColumn("value", said)
    return stream.parse_events(msgs).groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))


def message_dedup(s, d):
    m = src.envelopes(s, d)
    twice = m.unionByName(m.filter(F.col("offset") % 3 == 0)).withColumn("message_id", message_id(F.col("topic"), F.col("partition"), F.col("offset"), F.get_json_object("value", "$._timestamp")))
    return twice.dropDuplicates(["message_id"]).select("message_id", "offset")


def schema_union(s, d):
    f = src.feedback(s, d)
    return f.select("event_id", "user_id").unionByName(src.experiences(s, d).select(F.col("id").alias("event_id"), F.col("category_name")), allowMissingColumns=True)


def _lake(s: SparkSession, d: str) -> EventLake:
    base = s.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base is None and not s.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = f"{base or 'file://' + tempfile.mkdtemp(prefix='tidemill-lake-')}/lake-{s.sparkContext.applicationId}-{abs(hash(d))}"
    write_events(src.feedback(s, d), root, mode="overwrite", max_records=1_000_000)
    return EventLake(s, root)


def lake_roundtrip(s, d):
    df = _lake(s, d).read(D - timedelta(days=7), D, ["recommendation_feedback"])
    return flat(df.select("event_id", "user_id", "experience_id", "event_type", "event_timestamp"))


def partition_listing(s, d):
    return _lake(s, d).partitions().select("partition_event_type", F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))


def latest_partition(s, d):
    return flat(_lake(s, d).latest("recommendation_feedback_v1").select("event_id", "user_id", "event_timestamp"))


def _stream_events(s, d):
    good, _ = stream.split_events(stream.parse_events(src.envelopes(s, d)))
    return stream.deduplicate(good)


def stream_tumbling_features(s, d):
    out = stream.tumbling(_stream_events(s, d), 86400)
    return flat(out.select("user_id", "activity_count", "unique_event_types", "last_event_type", "engagement_score", F.date_format("window_start", "yyyyMMdd").alias("day")), 4)


def stream_session_features(s, d):
    out = stream.sessions(_stream_events(s, d), "6 hours")
    return flat(out.select("user_id", "activity_count", F.date_format("session_start", "yyyyMMddHHmmss").alias("began"), "session_duration_seconds"), 3)


def stream_realtime_user(s, d):
    out = stream.tumbling(_stream_events(s, d), 86400)
    return flat(out.select("user_id", F.date_format("window_start", "yyyyMMdd").alias("day"), "recent_categories_viewed", "recent_tags_interacted", "session_category_focus", "user_viewed_experiences"))


def experience_features(s, d):
    scored = src.feedback(s, d).withColumn("event_type", F.element_at(F.array(*[F.lit(x) for x in ("view", "click", "bookmark", "share", "rsvp")]), (F.col("event_id").cast("int") % 5 + 1)))
    out = features.experience_features(scored, D, src.experiences(s, d))
    return flat(out.select("experience_id", "exp_views_7d", "exp_actions_7d", "exp_avg_engagement_7d", "exp_city", "exp_price_tier", "is_valid", "event_timestamp"))


def online_upsert_diff(s, d):
    rows = src.profiles(s, d).select(F.col("id").alias("user_id"), F.col("current_address_city").alias("city"), F.col("social_score").alias("score"))
    old = rows.withColumn("score", F.when(F.col("user_id").cast("int") % 5 == 0, F.lit(-1)).otherwise(F.col("score")))
    return changed(as_entries(rows, "user_id", "u"), as_entries(old, "user_id", "u")).select("key", F.col("value")["city"].alias("city"), F.col("value")["score"].alias("score"))


def message_routing(s, d):
    return routing.process(src.app_messages(s, d)).select("topic", "offset", "kind", "error_reason", F.size("fields").alias("n_fields"))


def message_payloads(s, d):
    sound = routing.payloads(routing.process(src.app_messages(s, d)), "experience.v1.ExperienceCreated")
    return flat(sound.select("id", "name", "price_amount", "event_location_city", "event_location_latitude", "category_id", "category_name", F.transform("tags", lambda t: t["name"]).alias("tags"), "description"))


def message_feedback(s, d):
    rows = routing.payloads(routing.process(src.app_messages(s, d)), "feed.v1.RecommendationFeedback")
    return rows.select("event_id", "user_id", "experience_id", "view_data_dwell_time_ms")


def mixed_rows(s, d):
    """Profiles and experiences taken out of one frame of events of all types."""
    people = src.profiles(s, d).select("id", "social_score", F.when(F.col("id").cast("int") % 2 == 0, "user.v1.UserProfileCreated").alias("_event_type"), F.lit("user_profile_events").alias("partition_event_type"))
    items = src.experiences(s, d).select("id", "category_name", F.lit("experience.v1.ExperienceCreated").alias("_event_type"), F.lit("other").alias("partition_event_type"))
    acts = src.feedback(s, d).select(F.col("event_id").alias("id"), F.lit("feed.v1.RecommendationFeedback").alias("_event_type"), "partition_event_type")
    events = people.unionByName(items, allowMissingColumns=True).unionByName(acts, allowMissingColumns=True)
    return profile_rows(events).select("id", F.col("social_score").cast("string").alias("said")).unionByName(catalog_rows(events).select("id", F.col("category_name").alias("said")))


def top_elements(s, d):
    f = src.feedback(s, d)
    order = F.array_sort(F.collect_list(F.struct(F.col("event_id").cast("bigint").alias("n"), "event_type")))
    return flat(f.groupBy("user_id").agg(top_k_elements(F.transform(order, lambda r: r["event_type"]), 2).alias("top_types")))


QUERIES = {f.__name__: f for f in (
    user_engagement_raw, user_engagement_smoothed, experience_engagement_raw, experience_engagement_smoothed, session_features, user_top_categories, latest_profile, latest_content, user_features_full,
    user_profile, experience_profile, experience_features, merged_user_features, merged_experience_features, training_positives, training_negatives, two_tower, served_exploded, ranking_labels, label_distribution,
    ranking_context, ranking_training, pit_join, dq_null_rates, dq_numeric_range, dq_duplicates, dq_timestamp_validity, dq_split_valid, dq_flags, dq_validity_rate, dq_skew, dq_freshness, dq_input_report,
    dq_output, event_validator, message_dedup, schema_union, lake_roundtrip, partition_listing, latest_partition, stream_tumbling_features, stream_session_features, stream_realtime_user, online_upsert_diff,
    message_routing, message_payloads, message_feedback, mixed_rows, top_elements,
)} | {"position_features": position, "cross_features": cross}
