"""Point-in-time joins of feature views with expiry, and the registry of views."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = timedelta(days=1)


@dataclass(frozen=True)
class FeatureView:
    name: str
    entity: str
    ttl: timedelta
    features: list[str] = field(default_factory=list)
    source: str | None = None


# The views, their entities and lifetimes.
VIEWS = {
    "user_features": FeatureView("user_features", "user_id", 30 * DAY),
    "user_engagement": FeatureView("user_engagement", "user_id", DAY),
    "experience_features": FeatureView("experience_features", "experience_id", 30 * DAY),
    "experience_engagement": FeatureView("experience_engagement", "experience_id", DAY),
    "session_features": FeatureView("session_features", "session_id", timedelta(hours=2)),
}


def asof_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, ttl: timedelta | None = None) -> DataFrame:
    """left with the columns of the newest right row of its key that is not after it and not older than ttl; else nulls.

    One sort of the union by (key, time): the last right row before each left row is carried
    forward, so no pair of rows is formed. Right rows of one time: the greatest wins.
    """
    cols = [c for c in right.columns if c not in (key, right_ts)]
    names = {c: c if c not in left.columns else f"right_{c}" for c in cols}
    newest = right.filter(F.col(key).isNotNull() & F.col(right_ts).isNotNull()).groupBy(key, right_ts).agg(F.max(F.struct(*cols)).alias("_r") if cols else F.lit(None).alias("_r"))
    rows = left.select(F.col(key).alias("_k"), F.col(left_ts).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_l"), F.lit(None).cast(newest.schema["_r"].dataType).alias("_r"))
    facts = newest.select(F.col(key).alias("_k"), F.col(right_ts).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(rows.schema["_l"].dataType).alias("_l"), "_r")
    w = Window.partitionBy("_k").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = rows.unionByName(facts).withColumn("_f", F.last(F.when(F.col("_side") == 0, F.struct("_t", "_r")), ignorenulls=True).over(w)).filter("_side = 1")
    fresh = F.col("_f._t").isNotNull() & F.col("_k").isNotNull() & F.col("_t").isNotNull()
    if ttl is not None:
        fresh &= F.col("_f._t") >= F.col("_t") - F.make_dt_interval(secs=F.lit(ttl.total_seconds()))
    return carried.select("_l.*", F.when(fresh, F.col("_f._t")).alias("feature_timestamp"), *[F.when(fresh, F.col(f"_f._r.{c}")).alias(names[c]) for c in cols])


def historical_features(entities: DataFrame, views: dict[str, DataFrame], ts: str = "event_timestamp", registry: dict[str, FeatureView] | None = None) -> DataFrame:
    """Entities joined with each named view as of their time; columns are prefixed by the view."""
    out = entities
    for name, df in views.items():
        view = (registry or VIEWS)[name]
        wanted = view.features or [c for c in df.columns if c not in (view.entity, "event_timestamp")]
        side = df.select(view.entity, F.col("event_timestamp").alias("_ft"), *[F.col(c).alias(f"{name}__{c}") for c in wanted])
        out = asof_join(out, side, view.entity, ts, "_ft", view.ttl).drop("feature_timestamp")
    return out


def latest_features(df: DataFrame, view: FeatureView) -> DataFrame:
    w = Window.partitionBy(view.entity).orderBy(F.desc("event_timestamp"))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
