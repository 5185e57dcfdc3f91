"""Training sets: positives, deterministic negatives, graded ranking labels, context, position and cross features."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import distance_bucket, haversine, is_enum, position_features, same_city, time_bucket

POSITIVE_DWELL_MS = 3_000
# Graded labels.
LABELS = {"action": 1.0, "long_view": 0.7, "click": 0.5, "engaged_view": 0.3, "view": 0.1, "impression": 0.0}
LONG_DWELL_MS, ENGAGED_DWELL_MS = 10_000, 3_000


def positives(feedback: DataFrame, min_dwell_ms: int = POSITIVE_DWELL_MS) -> DataFrame:
    """The strongest engagement of each (user, experience): action 3, long view 2, click 1; ties by the latest, then the event id."""
    e, dwell = F.col("event_type"), F.coalesce("view_data_dwell_time_ms", F.lit(0))
    strength = F.when(is_enum(e, "action"), 3).when(is_enum(e, "view") & (dwell >= min_dwell_ms), 2).when(is_enum(e, "click"), 1)
    rows = feedback.withColumn("engagement_strength", strength).filter("engagement_strength IS NOT NULL AND user_id IS NOT NULL AND experience_id IS NOT NULL")
    w = Window.partitionBy("user_id", "experience_id").orderBy(F.desc("engagement_strength"), F.desc("event_timestamp"), "event_id")
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select("user_id", "experience_id", "engagement_strength", "event_timestamp", F.lit(1.0).alias("label"), F.lit("positive").alias("sample_type"))


def pool_number(x: Column) -> Column:
    """A number that another engine can compute too: the first 15 hex digits of the md5."""
    return F.conv(F.substring(F.md5(x), 1, 15), 16, 10).cast("bigint")


def _as_negatives(pairs: DataFrame) -> DataFrame:
    return pairs.select("user_id", "experience_id", F.lit(0).alias("engagement_strength"), F.lit(None).cast("timestamp_ntz").alias("event_timestamp"), F.lit(0.0).alias("label"), F.lit("random").alias("sample_type"))


def _prime_factors(n: int) -> list[int]:
    found, q = [], 2
    while q * q <= n:
        if n % q == 0:
            found.append(q)
            while n % q == 0:
                n //= q
        q += 1
    return found + [n] * (n > 1)


def negatives(pos: DataFrame, pool: DataFrame, per_positive: int = 4) -> DataFrame:
    """per_positive items of the pool for each positive, never a known positive of the user; fewer only where the pool has no more.

    No cross join: all items are numbered in the order of a hash, by the sizes of hash buckets and the
    rank within each. A user walks the numbers from a hashed start with a hashed step that has no
    common factor with their count, so that no number comes twice; the first ones that are not
    positives are the user's. A user's pairs are distinct.
    """
    number = lambda tag: pool_number(F.concat_ws("|", "user_id", F.lit(tag)))
    items = pool.select("experience_id").filter("experience_id IS NOT NULL").distinct().withColumn("bucket", F.pmod(pool_number(F.col("experience_id")), F.lit(1 << 16)))
    sizes = items.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    total = max(sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0], 1)
    before = sizes.select("bucket", (F.sum("size").over(Window.orderBy("bucket")) - F.col("size")).alias("before"))  # at most 65,536 rows
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("experience_id")) - 1
    numbered = items.withColumn("rank", rank).join(before, "bucket").select((F.col("before") + F.col("rank")).alias("r"), "experience_id")
    known = pos.select("user_id", "experience_id").distinct()
    users = known.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    coprime = lambda x: F.lit(True) if not (f := _prime_factors(total)) else ~F.array_contains(F.array(*[x % q == 0 for q in f]), True)
    begin = F.pmod(number("start"), F.lit(total)).alias("begin")
    near = F.pmod(number("step"), F.lit(total)) + 1
    step = F.pmod(F.filter(F.sequence(near, near + 127), coprime)[0], F.lit(total)).alias("step")  # 13 factors leave no longer gap than 74
    walk = users.select("user_id", "n", begin, step).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.least((per_positive + 1) * F.col("n"), F.lit(total)) - 1)).alias("k"))
    drawn = walk.withColumn("r", F.pmod(F.col("begin") + F.col("k") * F.col("step"), F.lit(total))).join(numbered, "r")
    free = drawn.join(known, ["user_id", "experience_id"], "left_anti").withColumn("turn", F.row_number().over(Window.partitionBy("user_id").orderBy("k")))
    return _as_negatives(free.filter(F.col("turn") <= per_positive * F.col("n")))


def cross_features(df: DataFrame, bucket: bool = True) -> DataFrame:
    """Distance and same-city columns where both sides have them."""
    km = haversine(F.col("user_location_lat"), F.col("user_location_lng"), F.col("exp_location_lat"), F.col("exp_location_lng"))
    out = df.withColumns({"cross_distance_km": km, "cross_same_city": same_city(F.col("user_city"), F.col("exp_city"))})
    return out.withColumn("cross_distance_bucket", distance_bucket(F.col("cross_distance_km"))) if bucket else out


def two_tower(feedback: DataFrame, users: DataFrame, experiences: DataFrame, d: date, per_positive: int = 4) -> DataFrame:
    pos = positives(feedback)
    samples = pos.unionByName(negatives(pos, experiences.select("experience_id"), per_positive)).drop("event_timestamp")
    both = samples.join(users, "user_id", "left").join(experiences, "experience_id", "left")
    return cross_features(both, bucket=False).withColumn("training_date", F.lit(d))


def served_items(served: DataFrame) -> DataFrame:
    """One row a recommended item; position counts from 0."""
    rows = served.filter("recommendations IS NOT NULL").select("request_id", "user_id", "session_id", F.col("event_timestamp").alias("served_at"), "trigger", F.posexplode("recommendations").alias("position", "r"))
    return rows.select("request_id", "user_id", "session_id", "served_at", "trigger", "position", F.col("r.event_id").alias("experience_id"), F.col("r.ranking_score").alias("ranking_score"))


def _rollup(feedback: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    e = F.col("event_type")
    rows = feedback.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    return rows.groupBy(*keys).agg(
        F.max(is_enum(e, "click").cast("int")).alias(f"{prefix}click"), F.max(is_enum(e, "action").cast("int")).alias(f"{prefix}action"), F.max(is_enum(e, "view").cast("int")).alias(f"{prefix}view"),
        F.max(F.when(is_enum(e, "view"), F.col("view_data_dwell_time_ms"))).alias(f"{prefix}dwell"), F.min("event_timestamp").alias(f"{prefix}first"),
    )


def ranking_labels(served: DataFrame, feedback: DataFrame, legacy_labels: bool = False) -> DataFrame:
    """Served items with graded labels: feedback of the request, else of the session. Without feedback an item is an impression (0.0)."""
    by_request = _rollup(feedback, ["request_id", "user_id", "experience_id"], "r_")
    by_session = _rollup(feedback, ["session_id", "user_id", "experience_id"], "s_")
    items = served_items(served).join(by_request, ["request_id", "user_id", "experience_id"], "left").join(by_session, ["session_id", "user_id", "experience_id"], "left")
    got = lambda n: F.coalesce(f"r_{n}", f"s_{n}")
    out = items.withColumns({"clicked": F.coalesce(got("click"), F.lit(0)), "acted": F.coalesce(got("action"), F.lit(0)), "viewed": F.coalesce(got("view"), F.lit(0)), "dwell_ms": F.coalesce(got("dwell"), F.lit(0)), "feedback_time": got("first")})
    seen = F.lit(True) if legacy_labels else F.col("viewed") == 1
    label = F.when(F.col("acted") == 1, LABELS["action"]).when(F.col("dwell_ms") >= LONG_DWELL_MS, LABELS["long_view"]).when(F.col("clicked") == 1, LABELS["click"]).when(F.col("dwell_ms") >= ENGAGED_DWELL_MS, LABELS["engaged_view"]).when(seen, LABELS["view"]).otherwise(LABELS["impression"])
    return out.withColumn("label", label).drop(*[f"{p}_{n}" for p in "rs" for n in ("click", "action", "view", "dwell", "first")])


def label_distribution(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("label")


def device_context(feedback: DataFrame) -> DataFrame:
    """The device of a request's first event (by time, then id), and its client's time."""
    names = ["platform", "app_version", "screen_width", "screen_height"]
    said = F.col("client_timestamp") if "client_timestamp" in feedback.columns else F.col("event_timestamp")
    cols = F.struct(*[F.col(f"device_context_{n}").alias(f"ctx_{n}") for n in names], said.alias("ctx_client_timestamp"))
    return feedback.filter("request_id IS NOT NULL").groupBy("request_id").agg(F.min_by(cols, F.struct("event_timestamp", "event_id")).alias("c")).select("request_id", "c.*")


def context_features(labelled: DataFrame, feedback: DataFrame) -> DataFrame:
    """Device and time of the request's feedback; without any the time is hour 12 of day 1 (Sunday = 1)."""
    t = F.col("ctx_client_timestamp")
    hour, dow = F.coalesce(F.hour(t), F.lit(12)), F.coalesce(F.dayofweek(t), F.lit(1))
    return labelled.join(device_context(feedback), "request_id", "left").withColumns({"ctx_hour_of_day": hour, "ctx_day_of_week": dow, "ctx_is_weekend": dow.isin(1, 7), "ctx_time_bucket": time_bucket(hour)})


def ranking_set(served: DataFrame, feedback: DataFrame, users: DataFrame, experiences: DataFrame, d: date) -> DataFrame:
    rows = context_features(ranking_labels(served, feedback), feedback).withColumns(position_features(F.col("position")))
    return cross_features(rows.join(users, "user_id", "left").join(experiences, "experience_id", "left")).withColumn("training_date", F.lit(d))
