"""Declared schemas and conform(): absent columns become typed nulls, other spellings and JSON text are folded in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .expressions import parse_time

_NAMED = "array<struct<id:string,name:string>>"
SCHEMAS = {
    "feedback": "user_id string, experience_id string, event_id string, event_type string, request_id string, session_id string, position int, event_timestamp timestamp_ntz, view_data_dwell_time_ms bigint, device_context_platform string, device_context_app_version string, device_context_screen_width int, device_context_screen_height int, partition_event_type string",
    "served": "request_id string, user_id string, session_id string, event_timestamp timestamp_ntz, trigger string, retrieval_model string, ranking_model string, recommendations array<struct<event_id:string,ranking_score:float>>",
    "experience": f"id string, name string, description string, category_id string, category_name string, event_location_latitude double, event_location_longitude double, event_location_city string, event_location_country string, price_amount double, price_currency int, start_time bigint, end_time bigint, bucket_size int, total_buckets int, creator_id string, creator_type string, tags {_NAMED}, created_at bigint, updated_at bigint",
    "user_profile": f"id string, gender int, social_score int, on_boarding_status int, current_address_city string, current_address_country string, current_address_latitude double, current_address_longitude double, interests {_NAMED}, created_at bigint, updated_at bigint",
}
ALIASES = {
    "experience_id": ["experienceId", "event_id"],
    "user_id": ["userId"],
    "session_id": ["sessionId"],
    "request_id": ["requestId"],
    "view_data_dwell_time_ms": ["view_data.dwell_time_ms", "viewData.dwellTimeMs"],
    "category_name": ["category.name", "category"],
    "category_id": ["category.id"],
    "event_location_latitude": ["event_location_coordinate_latitude", "event_location_coordinate.latitude", "eventLocation.latitude"],
    "event_location_longitude": ["event_location_coordinate_longitude", "event_location_coordinate.longitude", "eventLocation.longitude"],
    "event_location_city": ["city"],
    "current_address_latitude": ["current_address_coordinate_latitude", "current_address_coordinate.latitude"],
    "current_address_longitude": ["current_address_coordinate_longitude", "current_address_coordinate.longitude"],
    "event_timestamp": ["timestamp", "client_timestamp", "served_at", "created_at"],
}
PARTITION_NAMES = {"recommendation_feedback": "recommendation_feedback_v1"}


def _path(schema: T.StructType, dotted: str) -> T.DataType | None:
    kind: T.DataType = schema
    for part in dotted.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.names:
            return None
        kind = kind[part].dataType
    return kind


def _as(column: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return column
    if isinstance(want, (T.TimestampNTZType, T.TimestampType)):
        return (column if isinstance(have, (T.TimestampType, T.TimestampNTZType, T.DateType)) else parse_time(column)).cast(want)
    if isinstance(want, (T.ArrayType, T.StructType)) and isinstance(have, T.StringType):
        return F.from_json(column, want)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType) and isinstance(have.elementType, T.StringType) and isinstance(want.elementType, T.StructType):
        return F.transform(column, lambda x: F.struct(x.alias("id"), x.alias("name"))).cast(want)
    if isinstance(have, (T.StructType, T.ArrayType)) and isinstance(want, T.StringType):
        return F.to_json(column)
    return column.try_cast(want)


def conform(df: DataFrame, table: str, keep_rest: bool = False) -> DataFrame:
    """df with exactly the columns of the table (and its other ones with keep_rest): per row the first non-null spelling."""
    wanted = T.StructType.fromDDL(SCHEMAS[table])
    out = []
    for field in wanted:
        found = [(p, k) for p in [field.name, *ALIASES.get(field.name, [])] if (k := _path(df.schema, p)) is not None and not (p in ("category",) and isinstance(k, T.StructType))]
        parts = [_as(F.col(p), k, field.dataType) for p, k in found]
        out.append((F.coalesce(*parts) if parts else F.lit(None)).cast(field.dataType).alias(field.name))
    rest = [F.col(c) for c in df.columns if keep_rest and c not in wanted.names]
    return df.select(*out, *rest)
