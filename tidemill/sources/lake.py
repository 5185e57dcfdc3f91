"""The event lake: Parquet under event_type=/year=/month=/day=/hour=, read with partition pruning."""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import parse_time
from ..functions.schema import PARTITION_NAMES, conform

PARTS = ["partition_event_type", "year", "month", "day", "hour"]


def partition_date() -> Column:
    return F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))


def write_events(events: DataFrame, root: str, ts: str = "event_timestamp", mode: str = "append", max_records: int = 10_000, compression: str = "snappy", batch: int | None = None) -> None:
    """Archives rows by their own type and event time; rows without time go to year 1970.

    batch: a further partition; mode overwrite then replaces that batch's rows alone.
    """
    t = F.coalesce(F.col(ts), F.lit("1970-01-01 00:00:00").cast(events.schema[ts].dataType))
    parts = {"year": F.year(t), "month": F.date_format(t, "MM"), "day": F.date_format(t, "dd"), "hour": F.date_format(t, "HH")}
    writer = events.withColumns(parts).write.mode(mode).option("maxRecordsPerFile", max_records).option("compression", compression)
    if batch is None:
        writer.partitionBy(*PARTS).parquet(root)
    else:
        tagged = events.withColumns(parts | {"_batch_id": F.lit(batch)}).write.mode(mode).option("maxRecordsPerFile", max_records).option("compression", compression)
        tagged.option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS, "_batch_id").parquet(root)


class EventLake:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def _open(self, paths: list[str], merge: bool = True) -> DataFrame | None:
        try:
            return self.spark.read.option("basePath", self.root).option("mergeSchema", merge).parquet(*paths).drop("_batch_id")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER" in str(e):
                return None
            raise

    def _folders(self, start: date, end: date, types: list[str] | None) -> list[str]:
        """The folders of the days asked for, so that no footer outside them is read. One listing a month."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        kinds = "{" + ",".join(types) + "}" if types else "*"
        months: dict[tuple[int, int], list[int]] = {}
        for n in range((end - start).days + 1):
            d = start + timedelta(days=n)
            months.setdefault((d.year, d.month), []).append(d.day)
        either = lambda n: f"{n:02d},{n}"
        found = []
        for (y, m), days in months.items():
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/partition_event_type={kinds}/year={y}/month={{{either(m)}}}/day={{{','.join(map(either, days))}}}")
            found += [x.getPath().toString() for x in path.getFileSystem(conf).globStatus(path) or []]
        return sorted(found)

    def read(self, start: date, end: date, event_types: list[str] | None = None, table: str = "feedback") -> DataFrame:
        """Events of inclusive dates, conformed; an empty frame when there is nothing."""
        paths = self._folders(start, end, [PARTITION_NAMES.get(t, t) for t in event_types] if event_types else None)
        try:
            df = self._open(paths) if paths else None  # merging happens here
        except Exception as e:
            if not any(x in str(e) for x in ("MERGE", "INCOMPATIBLE", "merge")):
                raise
            df = self.read_conflicting(paths)
        if df is None:
            return self.spark.createDataFrame([], conform_schema(table))
        return conform(df, table, keep_rest=True)

    def _schemas(self, paths: list[str]) -> dict[str, list[str]]:
        """Paths by schema: a day's folder whole where its files agree, else its files one by one."""
        out: dict[str, list[str]] = {}
        for path in paths:  # days and files, not rows
            try:
                df = self._open([path])
            except Exception:
                if path.endswith(".parquet"):
                    raise
                for schema, files in self._schemas([f for f in list_files(self.spark, path) if f.endswith(".parquet")]).items():
                    out.setdefault(schema, []).extend(files)
                continue
            if df is not None:
                out.setdefault(df.schema.json(), []).append(path)
        return out

    def read_conflicting(self, paths: list[str]) -> DataFrame | None:
        """Folders whose schemas do not merge: one read for each schema, conflicting columns as JSON, united by name."""
        by_schema = {T.StructType.fromJson(json.loads(s)): p for s, p in self._schemas(paths).items()}
        kinds: dict[str, set[str]] = {}
        for schema in by_schema:
            for field in schema:
                kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
        out = None
        for schema, own in by_schema.items():
            df = self.spark.read.option("basePath", self.root).schema(schema).parquet(*own).drop("_batch_id")
            for field in schema:
                if len(kinds[field.name]) > 1:
                    nested = isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
                    df = df.withColumn(field.name, F.to_json(field.name) if nested else F.col(field.name).cast("string"))
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        return out

    def partitions(self, event_type: str | None = None) -> DataFrame:
        df = self._open([self.root], merge=False)
        if df is None:
            return self.spark.createDataFrame([], "partition_event_type string, year int, month int, day int")
        df = df.filter(F.col("partition_event_type") == event_type) if event_type else df
        return df.select(*PARTS[:-1]).distinct()

    def latest(self, event_type: str, table: str = "feedback") -> DataFrame:
        """The rows of the newest day of a type; only that partition is read."""
        newest = self.partitions(event_type).agg(F.max(partition_date())).first()[0]
        return self.spark.createDataFrame([], conform_schema(table)) if newest is None else self.read(newest, newest, [event_type], table)

    def event_types(self, allowed: list[str] | None = None) -> list[str]:
        df = self._open([self.root], merge=False)
        found = [] if df is None else [r[0] for r in df.select("partition_event_type").distinct().collect()]
        return sorted(t for t in found if not allowed or t in allowed)


def conform_schema(table: str) -> T.StructType:
    from ..functions.schema import SCHEMAS

    return T.StructType.fromDDL(SCHEMAS[table])


def read_or_empty(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A profile or catalog table, empty with its schema if the path is not there."""
    try:
        return conform(spark.read.parquet(path), table)
    except AnalysisException:
        return spark.createDataFrame([], conform_schema(table))


def read_offline(spark: SparkSession, base: str, on: date) -> DataFrame | None:
    """The offline features of a date, or None."""
    try:
        return spark.read.parquet(base).filter(F.col("date") == F.lit(on))
    except AnalysisException:
        return None


def list_files(spark: SparkSession, prefix: str) -> list[str]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(prefix)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    found, it = [], fs.listFiles(path, True)
    while it.hasNext():
        found.append(it.next().getPath().toString())
    return sorted(found)


def with_event_time(df: DataFrame) -> DataFrame:
    """event_timestamp by priority of the time columns that are there; unparseable times are null."""
    order = ["_timestamp", "clientTimestamp", "client_timestamp", "createdAt", "created_at", "servedAt", "served_at", "timestamp", "processed_at"]
    parts = [parse_time(F.col(c)) for c in order if c in df.columns]
    return df.withColumn("event_timestamp", (F.coalesce(*parts) if parts else F.lit(None)).cast("timestamp_ntz"))


def _mixed(events: DataFrame, part_of_name: str, partition: str, table: str) -> DataFrame:
    by_type = F.col("_event_type").contains(part_of_name) if "_event_type" in events.columns else F.lit(False)
    by_partition = (F.col("partition_event_type") == partition) if "partition_event_type" in events.columns else F.lit(False)
    return conform(events.filter(F.coalesce(by_type, F.lit(False)) | F.coalesce(by_partition, F.lit(False))), table)


def profile_rows(events: DataFrame) -> DataFrame:
    """The user profiles among events of all types, by their type's name or their partition."""
    return _mixed(events, "UserProfile", "user_profile_events", "user_profile")


def catalog_rows(events: DataFrame) -> DataFrame:
    """The experiences among events of all types, by their type's name or their partition."""
    return _mixed(events, "Experience", "experience_events", "experience")
