"""Data quality: every report is one aggregate pass; valid and invalid rows are complements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Limits of the checks.
OLDEST = "2020-01-01 00:00:00"
MAX_NULL_RATE, MAX_SKEW, MAX_AGE_HOURS = 0.05, 100.0, 24.0


def require_columns(df: DataFrame, columns: list[str]) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def _long(df: DataFrame, measures: dict[str, list[Column]], names: list[str]) -> DataFrame:
    """One pass over df, then one row a column."""
    flat = df.agg(F.count(F.lit(1)).alias("_total"), *[m.alias(f"{i}_{k}") for i, (c, ms) in enumerate(measures.items()) for k, m in enumerate(ms)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("_total").alias("total"), *[F.col(f"{i}_{k}").alias(n) for k, n in enumerate(names)]) for i, c in enumerate(measures)])
    return flat.select(F.explode(rows).alias("r")).select("r.*")


def null_rates(df: DataFrame, columns: list[str] | None = None, threshold: float = MAX_NULL_RATE) -> DataFrame:
    out = _long(df, {c: [F.count_if(F.col(c).isNull())] for c in columns or df.columns}, ["nulls"])
    share = F.when(F.col("total") > 0, F.col("nulls") / F.col("total")).otherwise(0.0)
    return out.withColumns({"null_rate": share, "ok": share <= threshold})


def numeric_ranges(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    numeric = columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    nan = lambda c: F.count_if(F.isnan(F.col(c).cast("double")))
    return _long(df, {c: [F.min(c).cast("double"), F.max(c).cast("double"), nan(c)] for c in numeric}, ["min_value", "max_value", "nan_count"])


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct_keys")).withColumn("duplicates", F.col("total") - F.col("distinct_keys"))


def time_validity(df: DataFrame, ts: str, now: Column) -> DataFrame:
    t = F.col(ts)
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(t.isNull()).alias("null_times"), F.count_if(t > now).alias("future_times"), F.count_if(t < F.lit(OLDEST).cast("timestamp_ntz")).alias("old_times"))


def key_skew(df: DataFrame, key: str, limit: float = MAX_SKEW) -> DataFrame:
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    out = per.agg(F.count(F.lit(1)).alias("keys"), F.max("n").alias("max_rows"), F.min("n").alias("min_rows"), F.avg("n").alias("avg_rows"))
    return out.withColumns({"skew": F.col("max_rows") / F.col("min_rows"), "ok": F.coalesce(F.col("max_rows") / F.col("min_rows") <= limit, F.lit(True))})


def freshness(df: DataFrame, ts: str, now: Column, max_age_hours: float = MAX_AGE_HOURS) -> DataFrame:
    age = F.timestamp_diff("SECOND", F.col("newest"), now) / F.lit(3600.0)
    return df.agg(F.max(ts).alias("newest")).select(age.alias("age_hours"), F.coalesce(age <= max_age_hours, F.lit(False)).alias("fresh"))


# ---------------------------------------------------------------- predicates
def not_null(c: Column) -> Column:
    return c.isNotNull()


def in_range(c: Column, low: float | None = None, high: float | None = None, allow_null: bool = True) -> Column:
    ok = reduce(lambda a, b: a & b, [c >= low] * (low is not None) + [c <= high] * (high is not None), F.lit(True))
    return F.when(c.isNull(), F.lit(allow_null)).otherwise(ok)


def string_length(c: Column, low: int = 0, high: int | None = None) -> Column:
    """Null fails."""
    n = F.length(c)
    return F.coalesce((n >= low) & ((n <= high) if high is not None else F.lit(True)), F.lit(False))


def in_enum(c: Column, values: list, allow_null: bool = True) -> Column:
    return F.when(c.isNull(), F.lit(allow_null)).otherwise(c.isin(values))


def quality_flags(df: DataFrame, checks: dict[str, Column], keep: bool = False) -> DataFrame:
    """is_valid: all checks hold. keep leaves each as its own column."""
    out = df.withColumns(checks) if keep else df
    return out.withColumn("is_valid", reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for c in checks.values()], F.lit(True)))


def validity_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if("is_valid").alias("valid")).withColumn("validity_rate", F.when(F.col("total") > 0, F.col("valid") / F.col("total")).otherwise(0.0))


def has_id(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")) != "", F.lit(False))


# Partitions and the id that their rows need.
ID_BY_PARTITION = {"recommendation_feedback": "user_id", "recommendation_served": "user_id", "user_profile": "id", "user": "id", "experience": "id"}


def row_is_valid(df: DataFrame) -> Column:
    """By partition_event_type the id that the row needs; without that column user_id, or else id. Unlisted partitions are invalid."""
    if "partition_event_type" not in df.columns:
        return has_id(F.col("user_id" if "user_id" in df.columns else "id"))
    kind, rule = F.col("partition_event_type"), F.lit(False)
    for part, column in ID_BY_PARTITION.items():
        if column in df.columns:
            rule = F.when(F.coalesce(kind.startswith(part), F.lit(False)), has_id(F.col(column))).otherwise(rule)
    return rule


def split_valid(df: DataFrame, rule: Column | None = None) -> tuple[DataFrame, DataFrame]:
    ok = F.coalesce(row_is_valid(df) if rule is None else rule, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def input_report(df: DataFrame, required: list[str], key: str, ts: str, now: Column) -> DataFrame:
    """Null rates, times and ids of an input in one pass: one row."""
    require_columns(df, required)
    t = F.col(ts)
    return df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required], F.count_if(t.isNull() | (t > now) | (t < F.lit(OLDEST).cast("timestamp_ntz"))).alias("bad_times"),
        F.count_if(~has_id(F.col(key))).alias("bad_ids"),
    )


def validated_output(df: DataFrame, key: str, ts: str = "event_timestamp") -> tuple[DataFrame, DataFrame]:
    """(rows with a key, one of each key and time; a one-row report of duplicates, null keys and NaN)."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    report = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(key).isNull()).alias("null_keys"), *[F.count_if(F.isnan(c)).alias(f"nan_{c}") for c in numeric]).join(duplicates(df, [key, ts]).select("duplicates"), F.lit(True))
    return df.filter(F.col(key).isNotNull()).dropDuplicates([key, ts]), report


# ---------------------------------------------------------------- stream events
# Fields that a message needs, by topic.
REQUIRED_FIELDS = {
    "user.account": ["user_id", "event_type", "timestamp"],
    "user.profile": ["user_id", "event_type", "timestamp"],
    "experience": ["user_id", "experience_id", "event_type", "timestamp"],
    "engagement": ["user_id", "event_type", "timestamp", "target_id"],
    "location.streams": ["user_id", "timestamp", "latitude", "longitude"],
    "events.raw": ["user_id", "event_type", "timestamp"],
}
DEFAULT_FIELDS = ["user_id", "timestamp"]


def event_error(df: DataFrame, topic: Column, instead: dict[str, Column] | None = None) -> Column:
    """The first fault of a parsed event, or null: missing fields, empty strings, coordinates that are no numbers in range, bad times.

    A time is a positive number, a numeric string or ISO text. Every topic needs a time, so a missing one is a missing field
    (but for location streams and unknown topics all need an event type too).
    """
    def any_of(fields: list[str], bad) -> Column:
        return reduce(lambda a, b: a | b, [bad((instead or {}).get(c, F.col(c) if c in df.columns else F.lit(None).cast("string"))) for c in fields])

    def by_topic(bad) -> Column:
        rule = any_of(DEFAULT_FIELDS, bad)
        for name, fields in REQUIRED_FIELDS.items():
            rule = F.when(topic == name, any_of(fields, bad)).otherwise(rule)
        return rule

    time = F.col("timestamp").cast("string")
    number, text = time.try_cast("double"), F.try_to_timestamp(time)
    def off(c: str, n: float) -> Column:
        if c not in df.columns:
            return F.lit(False)
        degrees = F.col(c).cast("string").try_cast("double")
        return F.col(c).isNotNull() & (degrees.isNull() | ~degrees.between(-n, n))

    return (
        F.when(by_topic(lambda c: c.isNull()), "missing_fields")
        .when(by_topic(lambda c: c.cast("string") == ""), "null_values")
        .when(F.coalesce(off("latitude", 90.0), F.lit(False)), "invalid_latitude")
        .when(F.coalesce(off("longitude", 180.0), F.lit(False)), "invalid_longitude")
        .when(F.coalesce(number <= 0, text.isNull()), "invalid_timestamp")
    )
