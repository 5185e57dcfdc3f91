"""User, experience and session features from feedback events, and profile and catalog features.

Windows end with the target date D inclusive: "7d" is [D-7, D+1), "30d" is [D-30, D+1), "1d" is [D-1, D+1).
The raw operators use plain ratios, the smoothed ones add a constant to the denominator.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import clamp, count_where, engagement_score, is_enum, is_kind, names_of, price_tier, rank_tier, rate, score_tier, smoothed_rate

TIME = "event_timestamp"


@dataclass(frozen=True)
class FeatureSettings:
    ctr_smoothing: float = 10.0
    rate_smoothing: float = 5.0
    dwell_low_ms: int = 1_000
    dwell_high_ms: int = 600_000
    session_gap_s: int = 1800
    top_categories: int = 5
    interest_cap: int = 20
    tag_cap: int = 10
    cold_start_below: int = 10


DEFAULTS = FeatureSettings()


def since(d: date, days: int) -> Column:
    return F.col(TIME) >= F.lit(d - timedelta(days=days)).cast("timestamp_ntz")


def within(d: date, days: int) -> Column:
    return since(d, days) & (F.col(TIME) < F.lit(d + timedelta(days=1)).cast("timestamp_ntz"))


def _stamp(df: DataFrame, d: date) -> DataFrame:
    return df.withColumns({"is_valid": F.lit(True), "event_timestamp": F.lit(d).cast("timestamp_ntz")})


def user_engagement(events: DataFrame, d: date, smoothed: bool = False, settings: FeatureSettings = DEFAULTS) -> DataFrame:
    """One row a user with an event in 30 days. smoothed: exact enum names, clamped dwell, smoothed rates, cold start by 7 days."""
    s, week = settings, since(d, 7)
    test = is_enum if smoothed else is_kind
    flag = {k: test(F.col("event_type"), k) for k in ("impression", "click", "view", "action", "negative")}
    dwell = F.coalesce("view_data_dwell_time_ms", F.lit(0))
    dwell = clamp(dwell, s.dwell_low_ms, s.dwell_high_ms) if smoothed else dwell
    names = {"impression": "impressions", "click": "clicks", "view": "views", "action": "actions", "negative": "negatives"}
    aggs = [count_where(flag[k] & week).alias(f"user_{n}_7d") for k, n in names.items()]
    aggs += [count_where(flag[k]).alias(f"user_{n}_30d") for k, n in names.items() if k != "negative"]
    aggs += [F.count_distinct(F.when(flag["click"] & week, F.col("experience_id"))).alias("user_unique_clicks_7d"), F.avg(F.when(flag["view"] & week, dwell)).alias("user_avg_dwell_time_ms_7d")]
    out = events.filter(within(d, 30) & F.col("user_id").isNotNull()).groupBy("user_id").agg(*aggs)
    c = lambda n: F.col(f"user_{n}")
    if smoothed:
        ctr, other = (lambda n, m: smoothed_rate(n, m, s.ctr_smoothing)), (lambda n, m: smoothed_rate(n, m, s.rate_smoothing))
        cold = c("impressions_7d") < s.cold_start_below
    else:
        ctr = other = rate
        cold = c("impressions_30d") + c("impressions_7d") < s.cold_start_below
    out = out.withColumns({"user_ctr_7d": ctr(c("clicks_7d"), c("impressions_7d")), "user_ctr_30d": ctr(c("clicks_30d"), c("impressions_30d")), "user_action_rate_7d": other(c("actions_7d"), c("clicks_7d")), "user_view_rate_7d": other(c("views_7d"), c("clicks_7d")), "user_is_cold_start": cold})
    return out.fillna(0.0, ["user_avg_dwell_time_ms_7d"]) if smoothed else out


def experience_engagement(events: DataFrame, d: date, smoothed: bool = False, fold_case: bool = False, settings: FeatureSettings = DEFAULTS) -> DataFrame:
    """One row an experience with an event in 7 days. Shares count as actions here (raw form), not for users."""
    s = settings
    test = is_enum if smoothed else (lambda c, k: is_kind(c, k, ("SHARE",) if k == "action" else ()))
    flag = {k: test(F.col("event_type"), k) for k in ("impression", "click", "view", "action")}
    aggs = [count_where(flag[k]).alias(f"exp_{n}_7d") for k, n in (("impression", "impressions"), ("click", "clicks"), ("view", "views"), ("action", "actions"))]
    aggs += [F.count_distinct("user_id").alias("exp_unique_viewers_7d"), F.count_distinct(F.when(flag["click"], F.col("user_id"))).alias("exp_unique_clickers_7d"), F.avg("position").alias("exp_avg_position_7d"), F.min("position").alias("exp_best_position_7d")]
    if not smoothed:
        aggs += [count_where(flag["view"] & since(d, 1)).alias("exp_total_views_1d"), F.avg(engagement_score(F.col("event_type"), fold_case)).alias("exp_avg_engagement_7d")]
    out = events.filter(within(d, 7) & F.col("experience_id").isNotNull()).groupBy("experience_id").agg(*aggs)
    c = lambda n: F.col(f"exp_{n}_7d")
    if smoothed:
        ctr, other = (lambda n, m: smoothed_rate(n, m, s.ctr_smoothing)), (lambda n, m: smoothed_rate(n, m, s.rate_smoothing))
    else:
        ctr = other = rate
    out = out.withColumns({"exp_ctr_7d": ctr(c("clicks"), c("impressions")), "exp_booking_rate_7d": other(c("actions"), c("clicks")), "exp_view_rate_7d": other(c("views"), c("clicks"))})
    if smoothed:
        return popularity_rank(out)
    return out.withColumns({"exp_total_views_7d": c("views"), "exp_bookmark_rate_7d": F.lit(0.0), "exp_share_rate_7d": F.lit(0.0), "exp_popularity_tier": score_tier(c("views"), c("clicks"))})


def popularity_rank(df: DataFrame, key: str = "experience_id", by: str = "exp_impressions_7d", slots: int = 64) -> DataFrame:
    """Tier by rank over all rows (by desc, then key), without a single-task sort: rows are counted by value and key range,
    the running count over these is small, and only rows of one value and range are numbered together."""
    cuts = df.agg(F.percentile_approx(key_number(F.col(key)), [i / slots for i in range(1, slots)]).alias("_cuts"))
    slot = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<bigint>")), lambda c: c < key_number(F.col(key))))
    spread = df.join(F.broadcast(cuts), F.lit(True)).withColumn("_slot", slot).drop("_cuts")
    per = spread.groupBy(by, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    before = per.select(by, "_slot", F.coalesce(F.sum("_n").over(Window.orderBy(F.col(by).desc(), "_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_total"))
    ranked = spread.join(before, [by, "_slot"]).withColumn("_rank", F.col("_before") + F.row_number().over(Window.partitionBy(by, "_slot").orderBy(key)))
    return ranked.withColumn("exp_popularity_tier", rank_tier(F.col("_rank"), F.col("_total"))).drop("_rank", "_before", "_total", "_slot")


def key_number(key: Column) -> Column:
    """The first seven bytes of a string as a number in the same order."""
    return F.conv(F.rpad(F.hex(F.substring(key.cast("string").cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")


def latest_row(df: DataFrame, key: str, ts: str) -> DataFrame:
    """The newest row of each key; of equal times the one with the smallest content."""
    w = Window.partitionBy(key).orderBy(F.col(ts).desc_nulls_last(), *[F.to_json(F.struct(*[c for c in df.columns if c != ts]))])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_categories(events: DataFrame, categories: DataFrame, d: date, k: int = 5) -> DataFrame:
    """The k most frequent categories of a user's clicks, actions and views in 30 days; ties by name.

    categories: (id, category_name), several versions allowed when updated_at is there.
    """
    known = latest_row(categories, "id", "updated_at") if "updated_at" in categories.columns else categories.dropDuplicates(["id"])
    known = known.filter(F.col("category_name").isNotNull()).select(F.col("id").alias("experience_id"), "category_name")
    liked = is_kind(F.col("event_type"), "click") | is_kind(F.col("event_type"), "action", ("SHARE",)) | is_kind(F.col("event_type"), "view")
    # counted before the join with the catalog: one row a user and item
    counts = events.filter(within(d, 30) & liked & F.col("user_id").isNotNull()).groupBy("user_id", "experience_id").agg(F.count(F.lit(1)).alias("n"))
    per = counts.join(known, "experience_id").groupBy("user_id", "category_name").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("user_id").orderBy(F.desc("n"), "category_name")
    best = per.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= k)
    return best.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rk", "category_name"))), lambda x: x["category_name"]).alias("user_top_categories"))


def user_features(events: DataFrame, d: date, profiles: DataFrame | None = None, categories: DataFrame | None = None, settings: FeatureSettings = DEFAULTS) -> DataFrame:
    """Raw engagement with the latest profile and category preferences."""
    out = user_engagement(events, d, settings=settings)
    if profiles is not None:
        p = latest_row(profiles, "id", "updated_at")
        out = out.join(p.select(F.col("id").alias("user_id"), names_of(F.col("interests")).alias("user_interests"), F.col("current_address_latitude").alias("user_location_lat"), F.col("current_address_longitude").alias("user_location_lng"), F.col("current_address_city").alias("user_city")), "user_id", "left")
    if categories is not None:
        out = out.join(top_categories(events, categories, d, settings.top_categories), "user_id", "left")
    stubs = {"user_avg_price_viewed": F.lit(0.0), "user_price_sensitivity": F.lit(0.0)}
    return _stamp(out.withColumns(stubs), d)


def experience_features(events: DataFrame, d: date, catalog: DataFrame | None = None) -> DataFrame:
    out = experience_engagement(events, d)
    if catalog is not None:
        out = out.join(experience_profile(latest_row(catalog, "id", "updated_at"), d), "experience_id", "left")
    return _stamp(out, d)


def session_features(events: DataFrame, d: date, settings: FeatureSettings = DEFAULTS, city: str | None = None) -> DataFrame:
    """Sessions of day D, numbered from 0 for each user: a gap of more than session_gap_s whole seconds opens the next one."""
    w = Window.partitionBy("user_id").orderBy(TIME)
    one = Window.partitionBy("user_id").orderBy(TIME, *[c for c in ("event_id",) if c in events.columns])
    second = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(TIME))
    day = events.filter(within(d, 0) & F.col("user_id").isNotNull()).withColumn("_city", F.col(city) if city else F.lit(None).cast("string"))
    day = day.withColumns({"_s": second, "_previous": F.lag(second).over(w), "_was": F.lag("_city").over(one)})
    opens = F.coalesce(F.col("_s") - F.col("_previous") > settings.session_gap_s, F.lit(False))
    day = day.withColumn("_n", F.sum(opens.cast("int")).over(w)).withColumn("_moved", (F.col("_was").isNotNull() & (F.col("_was") != F.col("_city"))).cast("int"))
    return day.groupBy("user_id", F.concat("user_id", F.lit("_"), F.col("_n").cast("string")).alias("session_id")).agg(
        (F.max("_s") - F.min("_s")).alias("session_duration_seconds"), F.count(F.lit(1)).alias("session_event_count"), F.coalesce(F.sum("_moved"), F.lit(0)).alias("session_location_changes"),
        F.count_distinct("experience_id").alias("session_unique_experiences"), F.lit(d).cast("timestamp_ntz").alias("event_timestamp"),
    )


def all_features(events: DataFrame, d: date, profiles: DataFrame | None = None, catalog: DataFrame | None = None) -> dict[str, DataFrame]:
    return {"user_features": user_features(events, d, profiles, catalog), "experience_features": experience_features(events, d, catalog), "session_features": session_features(events, d)}


def _days(ms: str, d: date) -> Column:
    return F.datediff(F.lit(d), F.to_date(F.timestamp_millis(F.col(ms))))


def in_bounds(x: Column, low: float, high: float) -> Column:
    return x.isNull() | x.between(low, high)


def user_profile(profiles: DataFrame, d: date, settings: FeatureSettings = DEFAULTS) -> DataFrame:
    """Profile features of conformed profiles; is_valid covers coordinates."""
    lat, lng = F.col("current_address_latitude"), F.col("current_address_longitude")
    age = _days("created_at", d)
    return profiles.select(
        F.col("id").alias("user_id"), lat.alias("user_location_lat"), lng.alias("user_location_lng"), F.col("current_address_city").alias("user_city"), F.col("current_address_country").alias("user_country"),
        F.col("gender").alias("user_gender"), F.coalesce("social_score", F.lit(0)).alias("user_social_score"), F.col("on_boarding_status").alias("user_onboarding_status"),
        names_of(F.col("interests"), settings.interest_cap, "id").alias("user_interest_ids"), names_of(F.col("interests"), settings.interest_cap).alias("user_interest_names"),
        F.coalesce(F.size("interests"), F.lit(0)).alias("user_interests_count"), age.alias("user_account_age_days"), F.coalesce(age < 7, F.lit(False)).alias("user_is_new"),
        F.coalesce(F.col("on_boarding_status") == 2, F.lit(False)).alias("user_onboarding_complete"), (lat.isNotNull() & lng.isNotNull()).alias("user_has_location"),
        (in_bounds(lat, -90, 90) & in_bounds(lng, -180, 180)).alias("is_valid"),
    )


def experience_profile(catalog: DataFrame, d: date, settings: FeatureSettings = DEFAULTS) -> DataFrame:
    lat, lng, price = F.col("event_location_latitude"), F.col("event_location_longitude"), F.coalesce("price_amount", F.lit(0.0))
    until = -_days("start_time", d)
    seats = F.coalesce(F.col("bucket_size") * F.col("total_buckets"), F.lit(0))
    return catalog.select(
        F.col("id").alias("experience_id"), F.col("name").alias("exp_name"), F.col("category_id").alias("exp_category_id"), F.col("category_name").alias("exp_category_name"),
        lat.alias("exp_location_lat"), lng.alias("exp_location_lng"), F.col("event_location_city").alias("exp_city"), F.col("event_location_country").alias("exp_country"), price.alias("exp_price_amount"), F.col("price_currency").alias("exp_price_currency"),
        F.col("creator_type").alias("exp_creator_type"), F.col("creator_id").alias("exp_creator_id"),
        until.alias("exp_days_until_start"), F.coalesce(until.between(0, 7), F.lit(False)).alias("exp_is_upcoming"), F.coalesce(until < 0, F.lit(False)).alias("exp_is_past"),
        ((F.col("end_time") - F.col("start_time")) / F.lit(3_600_000.0)).alias("exp_duration_hours"), seats.alias("exp_total_capacity"), (seats > 0).alias("exp_has_capacity"), (price == 0).alias("exp_is_free"), price_tier(price).alias("exp_price_tier"),
        _days("created_at", d).alias("exp_age_days"), F.coalesce(F.length("description"), F.lit(0)).alias("exp_description_length"),
        names_of(F.col("tags"), settings.tag_cap, "id").alias("exp_tag_ids"), names_of(F.col("tags"), settings.tag_cap).alias("exp_tag_names"), F.coalesce(F.size("tags"), F.lit(0)).alias("exp_tags_count"),
        (in_bounds(lat, -90, 90) & in_bounds(lng, -180, 180) & in_bounds(F.col("price_amount"), 0, 1_000_000)).alias("content_valid"),
    )


def merged_user_features(events: DataFrame, profiles: DataFrame, d: date) -> DataFrame:
    """Every profile, with smoothed engagement where there is any."""
    return user_profile(profiles, d).join(user_engagement(events, d, smoothed=True), "user_id", "left")


def merged_experience_features(events: DataFrame, catalog: DataFrame, d: date) -> DataFrame:
    return experience_profile(catalog, d).join(experience_engagement(events, d, smoothed=True), "experience_id", "left")
