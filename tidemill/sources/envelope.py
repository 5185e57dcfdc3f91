"""Message envelopes: JSON stand-ins for the schema-registry payloads, Confluent frames, dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = "_event_type string, _event_version int, _timestamp string, _trace_id string, user_id string, userId string, id string, session_id string, sessionId string, event_type string, timestamp string, created_at string, latitude string, longitude string, category_name string, category string, tags array<string>, experience_id string, experienceId string, target_id string, recommendations array<struct<event_id:string,experience_id:string>>, topic string, partition int, offset long, `1` string, `2` string"


def frame_id(value: Column) -> Column:
    """The schema id of a Confluent frame (magic byte 0, four bytes big-endian), or null."""
    framed = (F.octet_length(value) >= 5) & (F.hex(F.substring(value, 1, 1)) == "00")
    return F.when(framed, F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int"))


def frame_payload(value: Column) -> Column:
    return F.when(frame_id(value).isNotNull(), F.substring(value, F.lit(6), F.octet_length(value) - 5))


def frame(schema_id: int, payload: Column) -> Column:
    return F.concat(F.unhex(F.lit(f"00{schema_id:08x}")), payload)


def parse(messages: DataFrame, value: str = "value", schema: str = ENVELOPE) -> DataFrame:
    """messages with the fields of the envelope and _parse_error (null when well formed).

    The JSON is read once: a generator holds it, which the optimizer neither copies into filters nor moves.
    Errors: null value, empty_event (no text or no fields), type_error (JSON, but no object), malformed.
    """
    text = F.col(value).cast("string")
    struct = F.from_json(text, schema + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parsed = messages.select("*", F.explode(F.array(struct)).alias("_e"))
    bare = F.trim(text)
    error = (
        F.when(text.isNull(), "null value").when((bare == "") | bare.rlike(r"^\{\s*\}$"), "empty_event")
        .when(~bare.startswith("{") & F.expr(f"try_parse_json(cast({value} as string))").isNotNull(), "type_error")
        .when(F.col("_e._corrupt").isNotNull() | ~bare.startswith("{"), "malformed")
    )
    names = T.StructType.fromDDL(schema).names
    # the message's own topic, partition and offset stand before fields of these names in its body
    return parsed.select(*messages.columns, *[F.col(f"_e.`{n}`").alias(n) for n in names if n not in messages.columns], error.alias("_parse_error"))


def message_id(topic: Column, partition: Column, offset: Column, ts: Column) -> Column:
    return F.md5(F.concat_ws(":", topic, partition.cast("string"), offset.cast("string"), ts.cast("string")))


def dead_letters(rows: DataFrame, reason: Column, value: str = "value", limit: int = 1024) -> DataFrame:
    """Original value (base64 of what is not text, cut at `limit` bytes) with the reason."""
    raw = F.col(value).cast("binary")
    text = F.try_to_binary(F.base64(F.substring(raw, 1, limit)), F.lit("base64")).cast("string")
    keep = [c for c in ("topic", "partition", "offset", "key") if c in rows.columns]
    return rows.select(*[F.col(c).alias(f"original_{c}") for c in keep], F.when(F.is_valid_utf8(text), text).otherwise(F.base64(F.substring(raw, 1, limit))).alias("original_value"), reason.alias("error_reason"))


def dead_letter_json(rows: DataFrame, reason: Column, limit: int = 500) -> DataFrame:
    """One JSON object for each bad event: its fields as text, each cut at `limit` characters, and the reason."""
    fields = [F.substring(F.to_json(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f"`{f.name}`").cast("string"), 1, limit).alias(f.name) for f in rows.schema]
    return rows.select(F.to_json(F.struct(*fields, reason.alias("error_reason"))).alias("value"))
