import json
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemill.functions.expressions import snake, top_k_elements
from tidemill.plans import jobs
from tidemill.sources import envelope, lake, stores
from tidemill.sources.registry import NotRetryable, SchemaRegistry, local_transport, retried
from tidemill.streaming import features as stream
from tidemill.streaming import monitor, routing

MESSAGE = "value string, topic string, partition int, offset long"


def processed(spark, *messages):
    rows = [(m if m is None or isinstance(m, str) else json.dumps(m), topic, 0, i) for i, (m, topic) in enumerate(messages)]
    return routing.process(spark.createDataFrame(rows, MESSAGE))


def test_every_type_keeps_its_fields(spark):
    item = {"_event_type": "experience.v1.ExperienceCreated", "id": "e", "priceAmount": 5, "secret": "s", "name": None, "eventLocation": {"city": "c", "coordinate": {"latitude": 1.5}}, "tags": [{"id": "1", "name": "a", "more": 2}, "b", {"id": "2"}], "category": "plain"}
    user = {"_event_type": "user.v1.UserProfileUpdated", "id": "u", "avatarKey": "k", "onBoardedAt": 3, "interests": [], "currentAddress": {}, "phone": "1"}
    feed = {"_event_type": "feed.v1.RecommendationFeedback", "_timestamp": "9", "_trace_id": "t", "user_id": "u", "event_id": "e", "x": {"y": 1}}
    partner = {"_event_type": "partner.v1.PartnerProfileCreated", "id": "p", "name": "n"}
    other = {"_event_type": "new.v1.Thing", "a": 1, "_b": 2}
    got = [r.fields for r in processed(spark, (item, "t"), (user, "t"), (feed, "t"), (partner, "t"), (other, "t")).orderBy("offset").collect()]
    assert json.loads(got[0].pop("tags")) == [{"id": "1", "name": "a"}, {"id": "2", "name": None}]
    assert got == [
        {"id": "e", "price_amount": "5", "event_location_city": "c", "event_location_latitude": "1.5"}, {"id": "u", "avatar_key": "k", "on_boarded_at": "3"},
        {"_event_type": "feed.v1.RecommendationFeedback", "_timestamp": "9", "user_id": "u", "event_id": "e", "x": '{"y":1}'}, {"_event_type": "partner.v1.PartnerProfileCreated", "id": "p"}, {"_event_type": "new.v1.Thing", "a": "1"},
    ]


@pytest.mark.parametrize(
    "message, topic, reason",
    [
        ({"_event_type": "user.v1.UserProfileCreated"}, "t", "missing user_id/id in profile"), ({"id": "u"}, "user.profile", None), ({"user_id": "u"}, "user.profile.events", "missing user_id/id in profile"), ({}, "user.account", "missing user_id/id in account"),
        ({"_event_type": "user.v1.UserProfileUpdated"}, "user.profile", None), ({"id": ""}, "experience.events", "missing experience_id/id in experience"), ({"experience_id": "e"}, "experience", None), ({"name": "n"}, "partner.profile.events", "missing id in partner"),
        ({"user_id": None}, "engagement", "missing user_id in engagement"), ({"user_id": "u", "latitude": 1}, "location.streams", "missing latitude/longitude in location"), ({"user_id": "u", "latitude": 91, "longitude": 0}, "location.streams", "invalid latitude or longitude"),
        ({"user_id": "u", "latitude": -90, "longitude": 180}, "location.streams", None), ({"user_id": "u", "latitude": "north", "longitude": 0}, "location.streams", "invalid latitude or longitude"), ({"user_id": "u"}, "feed.recommendation_served", "missing request_id in served"),
        ({"request_id": "r"}, "feed.recommendation_served", "missing user_id in served"), ({"user_id": "u"}, "feed.recommendation_feedback", "missing event_id in feedback"), ({}, "other", None), ("{bad", "other", "malformed"), (None, "other", "malformed"), ("[1]", "other", "malformed"),
    ],
)
def test_ids_that_must_be_there(spark, message, topic, reason):
    assert processed(spark, (message, topic)).first().error_reason == reason


def test_accounts_are_skipped_and_json_is_read_once(spark):
    df = processed(spark, ({"_event_type": "user.v1.UserAccountCreated", "id": "u"}, "x"), ({"id": "u"}, "user.account.events"), ({"id": "u"}, None))
    assert [(r.offset, r.kind, r.processor_version) for r in df.collect()] == [(2, "all", "2.0.0")]
    good, bad = routing.split(df)
    assert (good.count(), bad.count()) == (1, 0)
    assert good.select("fields")._jdf.queryExecution().optimizedPlan().toString().count("from_json(MapType") == 1
    assert processed(spark, ({}, "t")).filter("offset > 0").count() == 0


def test_flattening_and_payload_tables(spark):
    feed = {"_event_type": "feed.v1.RecommendationFeedback", "user_id": "u", "event_id": "e", "view_data": {"dwell_time_ms": 7}, "device_context": {"platform": "p", "deep": {"x": 1}}, "device_context_platform": "old", "list": [1, {"a": 2}]}
    df = processed(spark, (feed, "t"))
    flat = routing.archive_rows(df).first().fields
    assert (flat["device_context_deep"], flat["list"], flat["device_context_platform"]) == ('{"x":1}', '[1,{"a":2}]', "old") and "view_data" not in flat
    r = routing.payloads(df, "feed.v1.RecommendationFeedback").first()
    assert (r.user_id, r.experience_id, r.view_data_dwell_time_ms) == ("u", "e", 7)
    served = {"_event_type": "feed.v1.RecommendationServedEvent", "user_id": "u", "request_id": "r", "served_at": "1706572800000", "recommendations": [{"event_id": "e", "ranking_score": 0.5}]}
    r = routing.payloads(processed(spark, (served, "t")), "feed.v1.RecommendationServedEvent").first()
    assert (r.request_id, r.event_timestamp, r.recommendations[0].event_id) == ("r", datetime(2024, 1, 30), "e")
    with pytest.raises(KeyError):
        routing.payloads(df, "unknown")


def test_users_from_tags(spark):
    rows = [({"userId": "a"}, "a"), ({"_event_type": "user.v1.X", "id": "b"}, "b"), ({"2": "user9"}, "user9"), ({"1": "x" * 20}, "x" * 20), ({"2": "short", "id": "short"}, None), ({"id": "user1"}, "user1")]
    df = spark.createDataFrame([(json.dumps(m), "events.raw", 0, i) for i, (m, _) in enumerate(rows)], MESSAGE)
    assert [r.user_id for r in stream.parse_events(df).orderBy("offset").collect()] == [w for _, w in rows]


def test_registry_caches_ids_and_frames(spark):
    calls = []
    inner = local_transport()
    reg = SchemaRegistry(lambda *a: (calls.append(a), inner(*a))[1])
    assert reg.by_id(1) is None and reg.latest("s") is None
    with pytest.raises(ValueError):
        reg.encode("s", F.lit(b""))
    assert (reg.register("s", "one"), reg.register("s", "two"), reg.register("s", "two")) == (1, 2, 2)
    n = len(calls)
    assert reg.by_id(1).text == "one" == reg.by_id(1).text and len(calls) == n + 1 and reg.latest("s").version == 2
    r = spark.range(1).select(reg.encode("s", F.lit(b"abc")).alias("v")).select(envelope.frame_id(F.col("v")).alias("i"), envelope.frame_payload(F.col("v")).alias("p")).first()
    assert (r.i, bytes(r.p)) == (2, b"abc")


def test_retries_then_dead_letters():
    waits, tries, dead = [], [], []

    def write(kind):
        def go(batch, n):
            tries.append(n)
            raise kind("no")

        return go

    for kind in (RuntimeError, NotRetryable):
        monitor.with_retry(write(kind), lambda b, n, why: dead.append((b, n, why)), sleep=waits.append)("batch", 4)
    assert (len(tries), waits, dead) == (4, [4.0, 4.0], [("batch", 4, "retryable error: no"), ("batch", 4, "no")])
    assert retried(lambda: 5) == 5


def test_lag_and_idle_time():
    now = [0.0]
    seen = monitor.Progress(lambda: now[0])
    source = {"latestOffset": {"t": {"0": 10, "1": 5}}, "endOffset": {"t": {"0": 4}}, "numInputRows": 3}
    seen.onQueryStarted(SimpleNamespace(id="q"))
    now[0] = 5.0
    seen.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(json=json.dumps({"id": "q", "sources": [source, {"endOffset": None, "latestOffset": None}]}))))
    now[0] = 7.0
    assert (seen.lags["q"], seen.rows["q"], seen.idle_seconds()) == ({("t", "0"): 6, ("t", "1"): 5}, 3, {"q": 2.0})
    seen.onQueryTerminated(SimpleNamespace(id="q", exception=None))
    assert seen.idle_seconds() == {}


def test_a_replayed_batch_is_archived_once(spark, tmp_path):
    df = spark.createDataFrame([("u", datetime(2024, 1, 30, 5), "x")], "user_id string, event_timestamp timestamp_ntz, partition_event_type string")
    for batch in (1, 1, 2):
        lake.write_events(df, f"{tmp_path}/lake", mode="overwrite", batch=batch)
    got = lake.EventLake(spark, f"{tmp_path}/lake").read(date(2024, 1, 30), date(2024, 1, 30))
    assert got.count() == 2 and "_batch_id" not in got.columns


def test_compaction_keeps_the_newest_versions(spark, tmp_path):
    store = stores.TableStore(spark, f"{tmp_path}/kv")
    store.compact()
    rows = lambda n: stores.as_entries(spark.createDataFrame([("u", n), ("v", n)], "user_id string, n int"), "user_id", "p")
    for n in (1, 2, 3):
        store.upsert(rows(n), n, 3600)
    store.delete(spark.createDataFrame([("p:v",)], "key string"), 4)
    for _ in range(2):
        store.compact()
    assert spark.read.parquet(f"{tmp_path}/kv").count() == 2 and store.get("p:u")["n"] == "3" and store.get("p:v") is None
    store.upsert(rows(5), 5, 3600)
    store.compact()
    assert store.get("p:v")["n"] == "5" and spark.read.parquet(f"{tmp_path}/kv").count() == 2


def test_dead_letters_as_json_are_cut(spark):
    df = spark.createDataFrame([("x" * 600, ["a"], None)], "a string, b array<string>, c int")
    got = json.loads(envelope.dead_letter_json(df, F.lit("why")).first().value)
    assert got == {"a": "x" * 500, "b": '["a"]', "error_reason": "why"}


def test_most_frequent_elements(spark):
    df = spark.createDataFrame([(["b", "a", "a", None, "c", "b"],), ([],), (None,)], "v array<string>")
    assert [r[0] for r in df.select(top_k_elements(F.col("v"), 2)).collect()] == [["b", "a"], [], []]
    assert snake("onBoardingStatus") == "on_boarding_status"


def test_merged_job_over_a_mixed_lake(spark, tmp_path):
    t = datetime(2024, 1, 30, 5)
    kind = "id string, user_id string, event_id string, event_type string, request_id string, session_id string, event_timestamp timestamp_ntz, social_score int, updated_at long, category_name string, _event_type string, partition_event_type string"
    rows = [("u", None, None, None, None, None, t, 7, 2, None, "user.v1.UserProfileCreated", "user_profile_events"), ("u", None, None, None, None, None, t, 6, 1, None, "user.v1.UserProfileUpdated", "user_profile_events")]
    rows += [("e", None, None, None, None, None, t, None, 1, "c", "experience.v1.ExperienceCreated", "experience_events"), (None, "u", "e", "EVENT_TYPE_VIEW", "r", "s", t, None, None, None, "feed.v1.RecommendationFeedback", "recommendation_feedback_v1")]
    lake.write_events(spark.createDataFrame(rows, kind), f"{tmp_path}/lake")
    got = jobs.run_merged(spark, f"{tmp_path}/lake", f"{tmp_path}/out", date(2024, 1, 30))
    assert (got["user_features_rows"], got["experience_features_rows"]) == (1, 1)
    r = spark.read.parquet(f"{tmp_path}/out/user_features").first()
    assert (r.user_id, r.user_social_score, r.user_views_7d) == ("u", 7, 1)
    assert jobs.run_merged(spark, f"{tmp_path}/lake", f"{tmp_path}/none", date(2024, 1, 30), dry_run=True)["user_features_rows"] == 1 and not (tmp_path / "none").exists()


def test_full_mode_replaces_every_date(spark, tmp_path):
    df = spark.createDataFrame([("u", 1)], "user_id string, n int")
    for on, full in ((date(2024, 1, 29), False), (date(2024, 1, 30), False), (date(2024, 1, 31), True)):
        stores.write_offline(df, f"{tmp_path}/f", on, replace_all=full)
    assert [r.date for r in spark.read.parquet(f"{tmp_path}/f").collect()] == [date(2024, 1, 31)]
