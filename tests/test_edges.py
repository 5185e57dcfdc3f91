import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.functions import expressions as x
from tidemill.functions.schema import conform
from tidemill.operators import asof, features, quality, training
from tidemill.sources import envelope, lake, stores
from tidemill.streaming import features as stream

D = date(2024, 1, 30)


def feedback(spark, rows):
    return conform(spark.createDataFrame(rows, "user_id string, experience_id string, event_id string, event_type string, event_timestamp timestamp_ntz, view_data_dwell_time_ms bigint, position int, request_id string, session_id string"), "feedback")


def event(t, kind="VIEW", user="u", item="e", n="1", dwell=None, request=None, session=None):
    return (user, item, n, kind, t, dwell, 3, request, session)


def test_windows_include_their_first_instant_and_exclude_the_end(spark):
    at = [datetime(2023, 12, 31), datetime(2023, 12, 30, 23, 59, 59), datetime(2024, 1, 23), datetime(2024, 1, 30, 23, 59, 59), datetime(2024, 1, 31)]
    got = features.user_engagement(feedback(spark, [event(t) for t in at]), D).first()
    assert (got.user_views_7d, got.user_views_30d) == (2, 3)


def test_case_folding_shares_and_cold_start(spark):
    t = datetime(2024, 1, 30)
    rows = feedback(spark, [event(t, k) for k in ("view", "VIEW", "EVENT_TYPE_VIEW", "SHARE")] + [event(t, "IMPRESSION") for _ in range(10)])
    user, item = features.user_engagement(rows, D).first(), features.experience_engagement(rows, D).first()
    assert (user.user_views_7d, user.user_actions_7d, user.user_is_cold_start) == (3, 0, False)
    assert item.exp_actions_7d == 1
    assert features.user_engagement(rows, D, smoothed=True).first().user_views_7d == 1


@pytest.mark.parametrize("gap, n", [(1799, 1), (1800, 1), (1800.5, 1), (1801, 2)])
def test_session_gap(spark, gap, n):
    t = datetime(2024, 1, 30, 8)
    assert features.session_features(feedback(spark, [event(t), event(t + timedelta(seconds=gap))]), D).count() == n


def test_strongest_engagement_wins(spark):
    t = datetime(2024, 1, 30)
    rows = [event(t, "EVENT_TYPE_CLICK"), event(t, "EVENT_TYPE_VIEW", dwell=3000), event(t, "EVENT_TYPE_VIEW", item="f", dwell=2999), event(t, "EVENT_TYPE_ACTION")]
    assert [(r.experience_id, r.engagement_strength) for r in training.positives(feedback(spark, rows)).collect()] == [("e", 3)]


def test_negatives_are_never_positives(spark):
    pos = training.positives(feedback(spark, [event(datetime(2024, 1, 30), "EVENT_TYPE_CLICK", item=str(i)) for i in range(5)]))
    got = training.negatives(pos, spark.range(20).select(F.col("id").cast("string").alias("experience_id")))
    assert got.count() and not {r.experience_id for r in got.collect()} & set("01234")


@pytest.mark.parametrize("items, known, per_positive", [(2000, 1, 1999), (2000, 3, 4), (20, 5, 4), (1, 1, 4), (0, 1, 4)])
def test_every_item_can_be_a_negative_and_none_is_missing(spark, items, known, per_positive):
    pos = training.positives(feedback(spark, [event(datetime(2024, 1, 30), "EVENT_TYPE_CLICK", item=str(i)) for i in range(known)]))
    got = [r.experience_id for r in training.negatives(pos, spark.range(items).select(F.col("id").cast("string").alias("experience_id")), per_positive).collect()]
    assert len(set(got)) == len(got) == max(0, min(known * per_positive, items - known)) and not set(got) & {str(i) for i in range(known)}


@pytest.mark.parametrize("kind, dwell, label", [("ACTION", None, 1.0), ("VIEW", 10_000, 0.7), ("CLICK", None, 0.5), ("VIEW", 3000, 0.3), ("VIEW", 2999, 0.1), ("NEGATIVE", None, 0.0)])
def test_labels_fall_back_to_the_session(spark, kind, dwell, label):
    t = datetime(2024, 1, 30)
    served = conform(spark.createDataFrame([("r", "u", "s", t, json.dumps([{"event_id": "e", "ranking_score": 0.5}]))], "request_id string, user_id string, session_id string, event_timestamp timestamp_ntz, recommendations string"), "served")
    for request in ("r", None):  # an event in two sessions must not double the item
        rows = feedback(spark, [event(t, f"EVENT_TYPE_{kind}", dwell=dwell, request=request, session=s) for s in ("s", "s2")])
        assert [r.label for r in training.ranking_labels(served, rows).collect()] == [label]


def test_asof_takes_the_newest_fresh_row(spark):
    left = spark.createDataFrame([("a", datetime(2024, 1, 2), 1), ("a", datetime(2024, 1, 9), 2), (None, datetime(2024, 1, 9), 3), ("b", datetime(2024, 1, 1), 4)], "k string, t timestamp_ntz, id int")
    right = spark.createDataFrame([("a", datetime(2024, 1, 1), 5), ("a", datetime(2024, 1, 2), 6), ("a", datetime(2024, 1, 3), 7), ("b", datetime(2024, 1, 2), 8)], "k string, ft timestamp_ntz, v int")
    got = asof.asof_join(left, right, "k", "t", "ft", timedelta(days=2))
    assert {r.id: r.v for r in got.collect()} == {1: 6, 2: None, 3: None, 4: None}


def test_conform_accepts_other_spellings(spark):
    df = spark.createDataFrame([("1", '[{"id":"a","name":"A"},{"id":"b","name":null}]', (1.5, 2.5), "12")], "id string, tags string, event_location_coordinate struct<latitude:double,longitude:double>, price_amount string")
    r = conform(df, "experience").select("*", x.names_of(F.col("tags")).alias("names")).first()
    assert (r.names, r.event_location_latitude, r.price_amount, r.category_name) == (["A"], 1.5, 12.0, None)


def test_time_forms(spark):
    df = spark.createDataFrame([("1706572800000",), ("1706572800",), ("2024-01-30T00:00:00Z",), ("soon",)], "t string").select(x.parse_time(F.col("t")).alias("t"))
    assert [r.t for r in df.collect()] == [datetime(2024, 1, 30)] * 3 + [None]


def test_split_is_a_partition_of_rows(spark):
    df = spark.createDataFrame([("u", "recommendation_served"), (" ", "user_profile_events"), (None, None), ("u", "other")], "user_id string, partition_event_type string")
    good, bad = quality.split_valid(df)
    assert (good.count(), bad.count()) == (1, 3)


def test_lake_with_conflicting_schemas(spark, tmp_path):
    base = f"{tmp_path}/lake"
    spark.createDataFrame([("u", ["a"])], "user_id string, tags array<string>").write.parquet(f"{base}/partition_event_type=x/year=2024/month=01/day=30/hour=00")
    spark.createDataFrame([("v", "b")], "user_id string, tags string").write.parquet(f"{base}/partition_event_type=x/year=2024/month=01/day=30/hour=01")
    got = {r.user_id: r.tags for r in lake.EventLake(spark, base).read(D, D).collect()}
    assert got == {"u": '["a"]', "v": "b"}
    assert lake.EventLake(spark, f"{tmp_path}/none").read(D, D).count() == 0


def test_offline_write_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([("u", 1)], "user_id string, n int")
    for on in (D, D, date(2024, 1, 29)):
        stores.write_offline(df, f"{tmp_path}/f", on)
    assert spark.read.parquet(f"{tmp_path}/f").count() == 2


def test_store_writes_changes_only(spark, tmp_path):
    store = stores.TableStore(spark, f"{tmp_path}/kv")
    rows = lambda n: stores.as_entries(spark.createDataFrame([("u", n), ("v", 1)], "user_id string, n int"), "user_id", "p")
    store.upsert(rows(1), 1, 3600)
    store.upsert(rows(2), 2, 3600)
    assert store.get("p:u") == {"user_id": "u", "n": "2"} and spark.read.parquet(f"{tmp_path}/kv").filter("version = 2").count() == 1
    store.delete(spark.createDataFrame([("p:u",)], "key string"), 3)
    assert store.get("p:u") is None and store.count("p:") == 1


def test_frames(spark):
    df = spark.range(1).select(envelope.frame(7, F.lit(b"abc")).alias("value"))
    r = df.select(envelope.frame_id(F.col("value")).alias("i"), envelope.frame_payload(F.col("value")).alias("p")).first()
    assert (r.i, bytes(r.p)) == (7, b"abc")


def test_stream_matches_batch(spark, tmp_path):
    base = {"_event_type": "engagement.v1", "user_id": "u", "event_type": "view", "category_name": "c1", "tags": ["a"], "latitude": 1.0, "longitude": 1.0}
    rows = [json.dumps(base | {"timestamp": str(1706572800000 + 1000 * i), "category_name": f"c{i % 7}", "latitude": 1.0 + i % 2}) for i in range(9)] + ["{bad", json.dumps({"event_type": "view", "timestamp": "1706572800000"})]
    src = spark.createDataFrame([(r, "events.raw", 0, i) for i, r in enumerate([*rows, rows[0]])], "value string, topic string, partition int, offset long")
    src = src.withColumn("offset", F.when(F.col("offset") == len(rows), F.lit(0)).otherwise(F.col("offset")))
    src.write.parquet(f"{tmp_path}/in")
    good, bad = stream.split_events(stream.parse_events(spark.readStream.schema(src.schema).parquet(f"{tmp_path}/in")))
    store = stores.TableStore(spark, f"{tmp_path}/kv")
    stream.start(stream.tumbling(stream.deduplicate(good), 30), stream.upsert_online(store), f"{tmp_path}/cp", once=True).awaitTermination(120)
    got = store.get("realtime:user:u")
    batch_good, batch_bad = stream.split_events(stream.parse_events(src))
    want = stream.tumbling(stream.deduplicate(batch_good), 30).first()
    assert got["activity_count"] == str(want.activity_count) == "9" and got["location_changes"] == str(want.location_changes) == "8"
    assert got["recent_categories_viewed"] == ",".join(want.recent_categories_viewed) == "c2,c3,c4,c5,c6"
    assert {r.error_reason for r in batch_bad.collect()} == {"malformed", "missing_fields"}


def test_json_is_read_once(spark):
    src = spark.createDataFrame([("{}", "events.raw", 0, 1)], "value string, topic string, partition int, offset long")
    good, _ = stream.split_events(stream.parse_events(src))
    plan = stream.tumbling(stream.deduplicate(good), 30)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_faults_of_messages(spark):
    base = {"_event_type": "feed.v1.RecommendationFeedback", "user_id": "u", "event_type": "view", "timestamp": "1706572800000"}
    cases = [
        (base, None), (base | {"user_id": ""}, "null_values"), (base | {"user_id": None, "userId": "w"}, None), (base | {"user_id": None}, "missing_fields"), (base | {"latitude": "abc"}, "invalid_latitude"), (base | {"latitude": 90.5}, "invalid_latitude"),
        (base | {"longitude": "-180"}, None), (base | {"longitude": 181}, "invalid_longitude"), (base | {"timestamp": -5}, "invalid_timestamp"), (base | {"timestamp": "2024-01-30T00:00:00Z"}, None), (base | {"timestamp": "soon"}, "invalid_timestamp"),
    ]
    rows = [(json.dumps(m), "events.raw", 0, i) for i, (m, _) in enumerate(cases)]
    rows += [(t, "events.raw", 0, len(cases) + i) for i, t in enumerate(["{}", " ", "[1]", "3", "{bad", None])]
    got = {r.offset: r.error_type for r in stream.parse_events(spark.createDataFrame(rows, "value string, topic string, partition int, offset long")).collect()}
    assert [got[i] for i in range(len(rows))] == [w for _, w in cases] + ["empty_event", "empty_event", "type_error", "type_error", "malformed", "null value"]


@pytest.mark.parametrize("inner, outer, name, weight", [("View", "a.B", "view", 1.0), ("unknown", "feed.v1.RecommendationFeedback", "recommendationfeedback", 0.5), ("", "feed.v1.Like", "like", 2.0), ("feedback_click", "x", "feedback_click", 2.0), (None, None, "unknown", 0.5)])
def test_event_names_and_weights(spark, inner, outer, name, weight):
    df = spark.createDataFrame([(inner, outer)], "event_type string, _event_type string")
    r = df.select(stream.event_name(df).alias("n"), stream.event_weight(stream.event_name(df)).alias("w")).first()
    assert (r.n, r.w) == (name, weight)


def test_every_item_of_a_large_pool_can_be_drawn(spark):
    pos = spark.range(3000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"), F.col("id").cast("string").alias("experience_id"))
    got = training.negatives(pos, spark.range(200_000).select(F.col("id").cast("string").alias("experience_id")), 40)
    n, distinct, high = got.agg(F.count(F.lit(1)), F.count_distinct("experience_id"), F.max(F.col("experience_id").cast("int"))).first()
    assert n == 120_000 and distinct > 80_000 and high > 199_900  # of 120,000 draws with replacement 90,000 would differ


def test_sessions_count_from_zero_and_moves(spark):
    t = datetime(2024, 1, 30, 8)
    rows = feedback(spark, [event(t, n="1"), event(t + timedelta(seconds=60), n="2"), event(t + timedelta(hours=3), n="3")]).withColumn("city", F.when(F.col("event_id") != "1", "b").otherwise("a"))
    got = {r.session_id: (r.session_location_changes, r.event_timestamp) for r in features.session_features(rows, D, city="city").collect()}
    assert got == {"u_0": (1, datetime(2024, 1, 30)), "u_1": (0, datetime(2024, 1, 30))}


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        df = spark.createDataFrame([("1706572800000",), ("2024-01-30T02:00:00+02:00",), ("2024-01-30 00:00:00",)], "t string").select(x.parse_time(F.col("t")).alias("t"))
        assert {r.t for r in df.collect()} == {datetime(2024, 1, 30)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_unchanged_content_is_not_written_for_its_time(spark):
    rows = lambda t: stores.as_entries(spark.createDataFrame([("u", 1, t)], "user_id string, n int, updated_at string"), "user_id", "p")
    assert stores.changed(rows("1"), rows("2")).count() == 0
