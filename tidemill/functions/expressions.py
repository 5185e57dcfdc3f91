"""Pure Column expressions: flags, rates, tiers, distances, times. No Python UDFs."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event names by kind, short and enum spelling.
KINDS = {
    "view": ["VIEW", "EVENT_TYPE_VIEW"],
    "click": ["CLICK", "EVENT_TYPE_CLICK"],
    "impression": ["IMPRESSION", "EVENT_TYPE_IMPRESSION"],
    "action": ["RSVP", "BOOK", "ACTION", "EVENT_TYPE_ACTION"],
    "negative": ["NEGATIVE", "EVENT_TYPE_NEGATIVE"],
}
# Engagement score of one event.
ENGAGEMENT = {"view": 0.2, "click": 0.4, "bookmark": 0.6, "share": 0.8, "rsvp": 1.0, "like": 0.4, "comment": 0.6, "follow": 0.4}
OTHER_ENGAGEMENT = 0.1
# Weights of stream events.
STREAM_WEIGHTS = {"view": 1.0, "click": 2.0, "bookmark": 3.0, "share": 4.0, "rsvp": 5.0, "like": 2.0, "comment": 3.0, "follow": 2.0}
OTHER_STREAM_WEIGHT = 0.5


def is_kind(event_type: Column, kind: str, extra: tuple[str, ...] = ()) -> Column:
    return F.coalesce(F.upper(event_type).isin([*KINDS[kind], *extra]), F.lit(False))


def is_enum(event_type: Column, kind: str) -> Column:
    """The exact enum name only."""
    return F.coalesce(event_type == f"EVENT_TYPE_{kind.upper()}", F.lit(False))


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def rate(n: Column, d: Column) -> Column:
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def smoothed_rate(n: Column, d: Column, k: float) -> Column:
    return n / (d + F.lit(k))


def lookup(value: Column, table: dict[str, float], other: float) -> Column:
    return reduce(lambda rest, kv: F.when(value == kv[0], F.lit(kv[1])).otherwise(rest), reversed(table.items()), F.lit(other))


def engagement_score(event_type: Column, fold_case: bool = False) -> Column:
    return lookup(F.lower(event_type) if fold_case else event_type, ENGAGEMENT, OTHER_ENGAGEMENT)


def score_tier(views: Column, clicks: Column) -> Column:
    score = views + 5 * clicks
    return F.when(score > 1000, "hot").when(score > 100, "popular").when(score > 10, "normal").otherwise("cold")


def rank_tier(rank: Column, total: Column) -> Column:
    return F.when(rank <= total * 0.1, "hot").when(rank <= total * 0.3, "popular").when(rank <= total * 0.7, "normal").otherwise("cold")


def price_tier(price: Column) -> Column:
    return F.when(price.isNull() | (price == 0), "free").when(price < 500, "budget").when(price < 2000, "standard").when(price < 5000, "premium").otherwise("luxury")


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6371.0) -> Column:
    """Great-circle distance in the unit of radius; null if a coordinate is."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def distance_bucket(km: Column) -> Column:
    return F.when(km.isNull(), "unknown").when(km <= 5, "nearby").when(km <= 20, "local").when(km <= 50, "regional").otherwise("distant")


def position_features(position: Column) -> dict[str, Column]:
    """position counts from 0; the bounds are inclusive."""
    flag = lambda n: F.coalesce(position <= n, F.lit(False)).cast("int")
    return {"position_normalized": position / F.lit(50.0), "is_top_3": flag(3), "is_top_10": flag(10), "is_top_20": flag(20), "is_first_page": F.coalesce(position <= 10, F.lit(False)), "position_bucket": F.when(position <= 3, "top_3").when(position <= 10, "top_10").when(position <= 20, "top_20").otherwise("below_20")}


def time_bucket(hour: Column) -> Column:
    return F.when(hour < 6, "night").when(hour < 12, "morning").when(hour < 17, "afternoon").when(hour < 21, "evening").otherwise("night")


def same_city(a: Column, b: Column) -> Column:
    return F.coalesce(F.lower(F.trim(a)) == F.lower(F.trim(b)), F.lit(False))


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 of a timestamp without time zone (or one, in the session's zone)."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def parse_time(text: Column) -> Column:
    """Milliseconds, seconds (under 1e12), numeric strings or ISO text as a timestamp without zone, in UTC, whatever the session's zone; null if it is neither."""
    number = text.cast("string").try_cast("double")
    ms = F.when(F.abs(number) >= 1e12, number).otherwise(number * 1000).cast("long")
    began = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    said = F.trim(text.cast("string"))
    # text with an offset names an instant: its seconds since 1970 do not depend on the session
    zoned = F.when(said.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), F.timestamp_add("MICROSECOND", F.unix_micros(F.try_to_timestamp(said)), began))
    return F.coalesce(F.timestamp_add("MILLISECOND", ms, began), zoned, said.try_cast("timestamp_ntz"))


def names_of(items: Column, cap: int | None = None, part: str = "name") -> Column:
    """The names (or ids) of an array of {id, name}; empty ones are left out."""
    items = F.slice(items, 1, cap) if cap else items
    return F.coalesce(F.filter(F.transform(items, lambda x: x[part]), lambda x: x.isNotNull() & (x != "")), F.array().cast("array<string>"))


def last_distinct(values: Column, n: int) -> Column:
    """The last n of the distinct values, in order of first appearance."""
    seen = F.array_compact(F.array_distinct(values))
    return F.slice(seen, F.greatest(F.size(seen) - n + 1, F.lit(1)), n)


def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once however often use names it."""
    return F.transform(F.array(value), use)[0]


def top_k_elements(values: Column, k: int = 3) -> Column:
    """The k most frequent elements of an array, ties by first appearance; nulls are left out, null and empty give an empty array."""

    def ranked(v: Column) -> Column:
        kinds = F.array_distinct(v)
        by_count = F.array_sort(F.transform(kinds, lambda x, i: F.struct((-F.size(F.filter(v, lambda y: y == x))).alias("n"), i.alias("i"), x.alias("x"))))
        return F.slice(F.transform(by_count, lambda r: r["x"]), 1, k)

    return let(F.array_compact(F.coalesce(values, F.array().cast("array<string>"))), ranked)
