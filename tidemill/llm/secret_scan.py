"""Secret scans over an incremental ledger of blobs.

Every text is a blob named by its SHA-256. The ledger, two written tables, records which (blob, rule
version) pairs have been scanned and what was found; a scan reads only the texts of pairs that it
has not seen, one path for each blob, and joins the findings back to all paths.

Cases: a null text is the empty blob; a null path is a path; rows repeated whole give repeated
results; an empty table leaves the ledger as it is; extra columns are ignored. Spans are code
points of the whole text, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap_of, fresh_path, marked, materialize, salted_left_join, slices, texts_of, without

#: Kind, pattern, the group whose length counts, the least length. The first three are the base kinds.
RULES = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),  # a whole run, as [0-9a-f]+ of 24 or more
    ("pem", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----"), 0, 1),
    ("github", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), 0, 1),
    ("slack", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"), 0, 1),
    ("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0, 1),
]
BASE = 3
#: Changes with any pattern, so that a blob is scanned again by rules that it has not met.
RULE_VERSION = hashlib.sha256(repr([(kind, p.pattern, p.flags, group, least) for kind, p, group, least in RULES]).encode()).hexdigest()[:16]
FINDINGS = "blob string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
NOTHING = hashlib.sha256(b"").hexdigest()


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rule, end) in order of start, then of rules."""
    found = [(m.start(), k, m.end()) for k, (_, pattern, group, least) in enumerate(RULES) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(found)


def describe(text: str) -> tuple[int, int, int, str, str]:
    spans = find_spans(text)
    said = lambda some: ",".join(f"{RULES[k][0]}:{a}:{b}" for a, k, b in some)
    base = said(x for x in spans if x[1] < BASE)
    return *(sum(k == i for _, k, _ in spans) for i in range(BASE)), hashlib.sha256(base.encode()).hexdigest(), said(spans)


class BlobLedger:
    """Findings by (blob, rule version), kept in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def read(self, rule_version: str = RULE_VERSION) -> DataFrame:
        """One row a blob scanned with this version, however often scans have written it; spans is empty where nothing was found."""
        own = f"{self.path}/rules={rule_version}"
        if not self._exists(own):
            return self.spark.createDataFrame([], FINDINGS)
        return self.spark.read.schema(FINDINGS).parquet(own).dropDuplicates(["blob"])

    def _exists(self, path: str) -> bool:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf).exists(p)

    def scan(self, paths: DataFrame, rule_version: str = RULE_VERSION) -> None:
        """Scans the blobs of paths(id, text) that this version has not seen, and records them.

        A blob with one path is scanned where it lies; only texts of blobs with several paths are moved, to keep one of them.
        """
        rows = paths.select("id", F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
        several = rows.groupBy("blob").agg(F.min("id").alias("one"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("blob", "one", "n")
        several = materialize(several, "ledger-several")
        rows = marked(rows, F.xxhash64("blob"), bitmap_of(several, F.xxhash64("blob")), "maybe")
        lone, close = rows.filter(~F.col("maybe")).select("blob", "text"), rows.filter("maybe")
        first = salted_left_join(close, several, ["blob"], F.xxhash64("id")).filter(F.col("n").isNull() | F.col("id").eqNullSafe(F.col("one")))
        unseen = lone.unionByName(first.select("blob", "text"))
        if self._exists(f"{self.path}/rules={rule_version}"):
            unseen = without(unseen, materialize(self.read(rule_version).select("blob"), "ledger-seen"), "blob")

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", 8 << 20):
                blobs = batch.column("blob").to_pylist()
                found = [describe(t.as_py()) for t in texts_of(batch.column("text"))]
                yield pa.RecordBatch.from_pydict({"blob": blobs, **{n: pa.array([f[i] for f in found], pa.int64() if i < BASE else pa.string()) for i, n in enumerate(["n_assign", "n_access", "n_hex", "base_sha256", "spans"])}})

        found = unseen.select("blob", "text").mapInArrow(look, FINDINGS)
        found.write.mode("append").parquet(f"{self.path}/rules={rule_version}")

    def findings(self, paths: DataFrame, rule_version: str = RULE_VERSION) -> DataFrame:
        """paths(id, text) -> id, blob and the findings of its blob, for every path."""
        rows = paths.select("id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"))
        hits = self.read(rule_version).filter("spans <> ''")
        joined = salted_left_join(rows, hits, ["blob"], F.xxhash64("id"))
        zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
        return joined.select("id", "blob", zero("n_assign"), zero("n_access"), zero("n_hex"), F.coalesce("base_sha256", F.lit(NOTHING)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def scan_secrets(paths: DataFrame, ledger: BlobLedger) -> DataFrame:
    ledger.scan(paths)
    return ledger.findings(paths)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    return scan_secrets(docs, BlobLedger(spark, fresh_path(spark, "ledger"))).select(F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans")
