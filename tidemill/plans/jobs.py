"""Entry points: batch features, training sets. `python -m tidemill.plans.jobs features --help`."""

from __future__ import annotations

import argparse
from contextlib import contextmanager
from datetime import date, timedelta
from time import perf_counter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feats
from ..operators import training
from ..operators.quality import split_valid, validated_output
from ..sources.lake import EventLake, catalog_rows, profile_rows, read_offline, read_or_empty
from ..sources.stores import TableStore, as_entries, latest_per_key, write_dead_letters, write_offline, write_training_set

LOOKBACK_DAYS = 30
KEYS = {"user_features": "user_id", "experience_features": "experience_id", "session_features": "session_id"}


def session(app: str = "tidemill", conf: dict[str, str] | None = None) -> SparkSession:
    base = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.sources.partitionOverwriteMode": "dynamic", "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    builder = SparkSession.builder.appName(app)
    for k, v in (base | (conf or {})).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


@contextmanager
def stage(name: str, metrics: dict[str, float]):
    began = perf_counter()
    try:
        yield
    finally:
        metrics[f"{name}_seconds"] = perf_counter() - began


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df that counts its rows while another action runs: no extra job."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def run_features(spark: SparkSession, lake: str, out: str, target: date, start: date | None = None, event_types: list[str] | None = None, skip_validation: bool = False, skip_online: bool = False, dry_run: bool = False, mode: str = "incremental") -> dict[str, float]:
    """Features of one date: read, validate (invalid rows to dead letters), compute, write offline and online.

    mode: full replaces the offline tables, incremental only the date's rows.
    """
    metrics: dict[str, float] = {}
    events = EventLake(spark, lake).read(start or target - timedelta(days=LOOKBACK_DAYS), target, event_types).persist()
    try:
        if not skip_validation:
            events_ok, bad = split_valid(events)
            if not dry_run:
                write_dead_letters(bad, f"{out}/dlq", "events", "invalid", target.isoformat())
        else:
            events_ok = events
        for name, df in feats.all_features(events_ok, target, read_or_empty(spark, f"{out}/profiles", "user_profile"), read_or_empty(spark, f"{out}/catalog", "experience")).items():
            with stage(name, metrics):
                good, _ = validated_output(df, KEYS[name])
                good, seen = counted(good, name)
                if dry_run:
                    good.write.format("noop").mode("overwrite").save()
                else:
                    write_offline(good, f"{out}/{name}", target, replace_all=mode == "full")
                    if not skip_online:
                        rows = latest_per_key(spark.read.parquet(f"{out}/{name}").filter(F.col("date") == F.lit(target)).drop("date"), KEYS[name])
                        TableStore(spark, f"{out}/online").upsert(as_entries(rows, KEYS[name], f"feast:{name}"), target.toordinal() * 10 + list(KEYS).index(name), 7 * 86400)
                metrics[f"{name}_rows"] = seen.get["rows"]
    finally:
        events.unpersist()
    return metrics


def run_training(spark: SparkSession, lake: str, features: str, out: str, target: date, lookback_days: int = 7, dry_run: bool = False) -> None:
    source = EventLake(spark, lake)
    begin = target - timedelta(days=lookback_days)
    feedback = source.read(begin, target, ["recommendation_feedback"])
    served = source.read(begin, target, ["recommendation_served"], table="served")
    users = read_offline(spark, f"{features}/user_features", target)
    users = users if users is not None else feedback.select("user_id").distinct()
    items = read_offline(spark, f"{features}/experience_features", target)
    items = items if items is not None else feedback.select("experience_id").distinct()
    users, items = users.drop("event_timestamp", "is_valid", "date"), items.drop("event_timestamp", "is_valid", "date")
    for c, kind in (("user_location_lat", "double"), ("user_location_lng", "double"), ("user_city", "string")):
        users = users if c in users.columns else users.withColumn(c, F.lit(None).cast(kind))
    for c, kind in (("exp_location_lat", "double"), ("exp_location_lng", "double"), ("exp_city", "string")):
        items = items if c in items.columns else items.withColumn(c, F.lit(None).cast(kind))
    sets = {"two_tower": training.two_tower(feedback, users, items, target), "ranking": training.ranking_set(served, feedback, users, items, target)}
    for name, df in sets.items():
        if dry_run:
            df.write.format("noop").mode("overwrite").save()
        else:
            write_training_set(df, f"{out}/training", name, target)


def run_merged(spark: SparkSession, lake: str, out: str, target: date, lookback_days: int = LOOKBACK_DAYS, training_sets: bool = False, dry_run: bool = False) -> dict[str, float]:
    """Content features of every profile and experience in the lake, merged with engagement; on demand the training sets of them."""
    metrics: dict[str, float] = {}
    events = EventLake(spark, lake).read(target - timedelta(days=lookback_days), target)
    newest = lambda df: latest_per_key(df.filter("id IS NOT NULL"), "id", "updated_at")
    profiles, catalog = newest(profile_rows(events)), newest(catalog_rows(events))
    merged = {"user_features": feats.merged_user_features(events, profiles, target), "experience_features": feats.merged_experience_features(events, catalog, target)}
    for name, df in merged.items():
        with stage(name, metrics):
            df, seen = counted(df.withColumn("event_timestamp", F.lit(target).cast("timestamp_ntz")), f"merged_{name}")
            if dry_run:
                df.write.format("noop").mode("overwrite").save()
            else:
                write_offline(df, f"{out}/{name}", target)
        metrics[f"{name}_rows"] = seen.get["rows"]
    if training_sets:
        with stage("training", metrics):
            run_training(spark, lake, out, out, target, dry_run=dry_run)
    return metrics


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemill")
    sub = parser.add_subparsers(dest="job", required=True)
    f = sub.add_parser("features")
    t = sub.add_parser("training")
    m = sub.add_parser("merged")
    for p in (f, t, m):
        p.add_argument("--target-date", type=date.fromisoformat)
        p.add_argument("--lake", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--dry-run", action="store_true")
    f.add_argument("--start-date", type=date.fromisoformat)
    f.add_argument("--end-date", type=date.fromisoformat, help="the date of the features where no target date is given")
    f.add_argument("--mode", choices=["full", "incremental"], default="incremental")
    f.add_argument("--event-types", type=lambda s: [x for x in s.split(",") if x], help="comma-separated; all by default")
    f.add_argument("--skip-validation", action="store_true")
    f.add_argument("--skip-online-write", action="store_true")
    t.add_argument("--features")
    t.add_argument("--lookback-days", type=int, default=7)
    m.add_argument("--lookback-days", type=int, default=7)
    m.add_argument("--generate-training-data", action="store_true")
    a = parser.parse_args(argv)
    a.target_date = a.target_date or getattr(a, "end_date", None) or date.today() - timedelta(days=1)
    spark = session(f"tidemill-{a.job}")
    if a.job == "features":
        run_features(spark, a.lake, a.out, a.target_date, a.start_date, a.event_types, a.skip_validation, a.skip_online_write, a.dry_run, a.mode)
    elif a.job == "merged":
        run_merged(spark, a.lake, a.out, a.target_date, a.lookback_days, a.generate_training_data, a.dry_run)
    else:
        run_training(spark, a.lake, a.features or a.out, a.out, a.target_date, a.lookback_days, a.dry_run)


if __name__ == "__main__":
    main()
