"""Application messages by type: which are skipped, which fields stay, which ids must be there.

A message's JSON is read once, to a map of its top-level fields; everything else is an expression on that map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import let, snake
from ..functions.schema import ALIASES, SCHEMAS, conform
from ..sources.envelope import dead_letters, message_id

# Names of types, topics and fields as producers send them.
PAYLOADS = {
    "user.v1.UserProfileCreated": "user_profile", "user.v1.UserProfileUpdated": "user_profile", "experience.v1.ExperienceCreated": "experience", "feed.v1.RecommendationServedEvent": "served", "feed.v1.RecommendationFeedback": "feedback",
    "user.v1.UserAccountCreated": "account", "partner.v1.PartnerProfileCreated": "account", "partner.v1.PartnerAccountCreatedPayload": "account", "admin.v1.AdminAccountCreatedPayload": "account",
}
SKIPPED_TYPE, SKIPPED_TOPIC = "user.v1.UserAccountCreated", "user.account.events"
EXPERIENCE_FIELDS = ["id", "name", "description", "creatorId", "creatorType", "thumbnailKey", "priceAmount", "priceCurrency", "startTime", "endTime", "bucketSize", "totalBuckets", "createdAt", "updatedAt"]
PROFILE_FIELDS = ["id", "dob", "gender", "avatarKey", "socialScore", "status", "createdAt", "updatedAt", "onBoardingStatus", "onBoardedAt"]
PROCESSOR_VERSION = "2.0.0"
# Ids that must be there, each with its alternatives, and which messages they are asked of: by type, else by topic.
REQUIRED = {
    "account": [["user_id", "id"]], "profile": [["user_id", "id"]], "experience": [["experience_id", "id"]], "partner": [["id"]], "engagement": [["user_id"]], "location": [["user_id"]],
    "served": [["request_id"], ["user_id"]], "feedback": [["user_id"], ["event_id"]],
}
CHECK_BY_TYPE = {
    "user.v1.UserAccountCreated": "account", "user.v1.UserProfileCreated": "profile", "experience.v1.ExperienceCreated": "experience", "partner.v1.PartnerProfileCreated": "partner",
    "feed.v1.RecommendationServedEvent": "served", "feed.v1.RecommendationFeedback": "feedback",
}
CHECK_BY_TOPIC = {
    "user.account": "account", "user.account.events": "account", "user.profile": "profile", "user.profile.events": "profile", "experience": "experience", "experience.events": "experience", "partner.profile.events": "partner", "partner.account.events": "partner",
    "engagement": "engagement", "location.streams": "location", "feed.recommendation_served": "served", "feed.recommendation_feedback": "feedback",
}


def kind_of(event_type: Column, topic: Column) -> Column:
    """skip, experience, profile, partner or all: what becomes of the fields."""
    return (
        F.when((event_type == SKIPPED_TYPE) | (topic == SKIPPED_TOPIC), "skip")
        .when((event_type == "experience.v1.ExperienceCreated") | (topic == "experience.events"), "experience")
        .when(event_type.isin("user.v1.UserProfileCreated", "user.v1.UserProfileUpdated") | (topic == "user.profile.events"), "profile")
        .when(event_type.isin("feed.v1.RecommendationServedEvent", "feed.v1.RecommendationFeedback") | topic.isin("recommendation.served", "recommendation.feedback.v1"), "all")
        .when((event_type == "partner.v1.PartnerProfileCreated") | topic.contains("partner"), "partner")
        .otherwise("all")
    )


def _named(text: Column) -> Column:
    """A JSON array's objects with their id and name alone, as JSON; null for an empty array."""
    objects = F.filter(F.from_json(text, "array<string>"), lambda x: x.startswith("{"))
    pairs = F.transform(objects, lambda x: F.struct(F.get_json_object(x, "$.id").alias("id"), F.get_json_object(x, "$.name").alias("name")))
    return F.when(F.size(F.from_json(text, "array<string>")) > 0, F.to_json(pairs, {"ignoreNullFields": "false"}))


def _kept(f: Column, direct: list[str], place: str, more: dict[str, Column]) -> Column:
    where = {f"{snake(place)}_{n}": F.get_json_object(f[place], f"$.{p}") for n, p in (("city", "city"), ("latitude", "coordinate.latitude"), ("longitude", "coordinate.longitude"))}
    pairs = {snake(n): f[n] for n in direct} | where | more
    return F.map_filter(F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())


def prune(f: Column, kind: Column) -> Column:
    """The fields that are archived. Names of experiences and profiles become snake_case; a null field is an absent one there."""
    inside = lambda n, p: F.when(f[n].startswith("{"), F.get_json_object(f[n], p))
    return (
        F.when(kind == "experience", _kept(f, EXPERIENCE_FIELDS, "eventLocation", {"tags": _named(f["tags"]), "category_id": inside("category", "$.id"), "category_name": inside("category", "$.name")}))
        .when(kind == "profile", _kept(f, PROFILE_FIELDS, "currentAddress", {"interests": _named(f["interests"])}))
        .when(kind == "partner", F.map_filter(f, lambda k, v: k.isin("id", "_event_type")))
        .otherwise(F.map_filter(f, lambda k, v: ~k.startswith("_") | k.isin("_event_type", "_timestamp")))
    )


def _check_of(event_type: Column, topic: Column) -> Column:
    table = lambda t: F.create_map(*[F.lit(x) for kv in t.items() for x in kv])
    return F.when(event_type != "", table(CHECK_BY_TYPE)[event_type]).otherwise(table(CHECK_BY_TOPIC)[topic])


def id_fault(f: Column, event_type: Column, topic: Column) -> Column:
    """Why a message cannot be processed (an empty id is a missing one), or null. Unknown types and topics are not checked."""
    check = _check_of(event_type, topic)
    absent = lambda names: F.forall(F.array(*[F.coalesce(f[n], F.lit("")) for n in names]), lambda x: x == "")
    faults = [F.when((check == c) & absent(names), f"missing {'/'.join(names)} in {c}") for c, asked in REQUIRED.items() for names in asked]
    lat, lng = f["latitude"].try_cast("double"), f["longitude"].try_cast("double")
    bounds = F.coalesce(lat.between(-90, 90) & lng.between(-180, 180), F.lit(False))
    here = check == "location"
    return F.coalesce(*faults, F.when(here & (f["latitude"].isNull() | f["longitude"].isNull()), "missing latitude/longitude in location"), F.when(here & ~bounds, "invalid latitude or longitude"))


def process(messages: DataFrame, now: Column | None = None) -> DataFrame:
    """messages (value, topic, partition, offset) that are not skipped, with _event_type, kind, fields (pruned), error_reason
    (null when sound), message_id, processed_at and processor_version.

    A value that is null or no JSON object has the reason malformed. Repeated messages have one message_id; drop them by it.
    """
    text = F.col("value").cast("string")
    read = messages.select("*", F.explode(F.array(F.struct(F.from_json(text, "map<string,string>").alias("m")))).alias("_r"))
    event_type = F.coalesce(F.col("_r.m")["_event_type"], F.lit(""))
    topic = F.coalesce("topic", F.lit(""))
    read = read.withColumns({"_event_type": event_type, "kind": kind_of(event_type, topic)}).filter("kind <> 'skip'")
    # a second generator: the pruned fields are used by the check and by the reader
    read = read.select("*", F.explode(F.array(F.struct(prune(F.col("_r.m"), F.col("kind")).alias("f")))).alias("_p"))
    fault = F.when(F.col("_r.m").isNull(), "malformed").otherwise(id_fault(F.col("_p.f"), F.col("_event_type"), topic))
    said = F.coalesce(F.col("_r.m")["_timestamp"], F.col("_r.m")["timestamp"])
    return read.select(
        *messages.columns, "_event_type", "kind", F.col("_p.f").alias("fields"), fault.alias("error_reason"), message_id(F.col("topic"), F.col("partition"), F.col("offset"), said).alias("message_id"),
        (F.current_timestamp() if now is None else now).alias("processed_at"), F.lit(PROCESSOR_VERSION).alias("processor_version"),
    )


def split(processed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound messages, dead letters)."""
    return processed.filter("error_reason IS NULL"), dead_letters(processed.filter("error_reason IS NOT NULL"), F.col("error_reason"))


def flatten(f: Column) -> Column:
    """Objects one level deep become a_b; arrays stay JSON text. Of equal names the last wins. A string that itself holds a JSON object is taken for one."""
    inner = lambda e: F.transform(F.map_entries(F.from_json(e["value"], "map<string,string>")), lambda n: F.struct(F.concat(e["key"], F.lit("_"), n["key"]).alias("key"), n["value"].alias("value")))
    spread = F.flatten(F.transform(F.map_entries(f), lambda e: F.coalesce(F.when(e["value"].startswith("{"), inner(e)), F.array(F.struct(e["key"].alias("key"), e["value"].alias("value"))))))
    last = lambda es: F.filter(es, lambda e, i: F.array_position(F.transform(es, lambda x: x["key"]), e["key"]) == i + 1)
    return F.map_from_entries(let(F.reverse(spread), last))


def payloads(processed: DataFrame, event_type: str) -> DataFrame:
    """The messages of a registered type as rows of its declared table, with message_id; KeyError for an unknown type."""
    own = processed.filter((F.col("_event_type") == event_type) & F.col("error_reason").isNull())
    own = own.select("message_id", F.explode(F.array(flatten(F.col("fields")))).alias("f"))
    if PAYLOADS[event_type] == "account":
        return own.select("message_id", F.col("f")["id"].alias("id"))
    table = PAYLOADS[event_type]
    wanted = T.StructType.fromDDL(SCHEMAS[table]).names
    spellings = dict.fromkeys(n.replace(".", "_") for w in wanted for n in (w, *ALIASES.get(w, [])))
    rows = own.select("message_id", *[F.col("f")[n].alias(n) for n in spellings])
    return conform(rows, table, keep_rest=True).select("message_id", *wanted)


def archive_rows(processed: DataFrame) -> DataFrame:
    """Sound messages as rows for the event lake: flattened fields as one map, partition type from the topic."""
    good, _ = split(processed)
    return good.select("message_id", "topic", "processed_at", "processor_version", "_event_type", flatten(F.col("fields")).alias("fields"), F.regexp_replace("topic", r"[.\-]", "_").alias("partition_event_type"))
