"""URL filters by a path-template tree.

Each host has a tree of path segments. Numbers and hex strings inside a segment become wildcards
at once. Then, level by level, children with less than min_support urls become `*`, and siblings
whose remaining paths and labelled bad rates do not differ (two-proportion test) are merged. A
template is blocked when its smoothed share of bad labels, drawn towards that of its host, reaches
block_at. Rules by host suffix and path prefix override the verdict; the longest fitting rule wins.

All statistics are aggregates over all urls. A node may have any number of children: siblings are
binned by their counts, and the bins of a node are clustered as a stream.

Paths have any depth. A node with less than min_support urls is not refined further, and what all
paths of a node share is passed in one step, so there is one round for each level that branches.

Cases: a null url, or one without `://`, has empty host and path and the root template; urls that repeat count each time; without labels, everything is
allowed by the method; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, materialize, salted_left_join


@dataclass(frozen=True)
class Rule:
    action: str  # block or allow
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class TemplateSettings:
    min_support: int = 20
    merge_z: float = 1.96
    prior_weight: float = 8.0
    block_at: float = 0.5


RULES = [Rule("block", "com", "/en/"), Rule("allow", "example.com", "/en/7"), Rule("allow", "net", "/de/"), Rule("block", "example.net", "/de/8"), Rule("block", "org", "/es/")]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule string, action) of the longest fitting rule, or nulls."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # longer ones come later and win
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, action = F.when(fits, F.lit(r.text)).otherwise(name), F.when(fits, F.lit(r.action)).otherwise(action)
    return name, action


def segments_of(path: Column) -> Column:
    """Segments with numbers and hex strings generalised."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.regexp_replace(F.regexp_replace(s, r"(?i)\b(?=[0-9a-f-]*[0-9])[0-9a-f-]{12,}\b", "<hex>"), r"[0-9]+", "<n>"))


def _clusters(z: float):
    def clusters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bins come sorted by node, rest and rate. One joins the last cluster of its node and rest unless their rates differ; only that cluster is held."""
        node, bad, lab, number = None, 0, 0, 0
        for batch in batches:
            rows = batch.to_pydict()
            out = []
            for host, tmpl, rest, own_lab, own_bad, k in zip(*(rows[c] for c in ("host", "tmpl", "rest", "lab", "bad", "k")), strict=True):
                p = (bad + own_bad + 0.5) / (lab + own_lab + 1)
                spread = (p * (1 - p) * (1 / (lab + 1) + 1 / (own_lab + 1))) ** 0.5
                if node == (host, tmpl, rest) and abs((bad + 0.5) / (lab + 1) - (own_bad + 0.5) / (own_lab + 1)) <= z * spread:
                    bad, lab = bad + k * own_bad, lab + k * own_lab
                else:
                    number = number + 1 if node == (host, tmpl, rest) else 0
                    node, bad, lab = (host, tmpl, rest), k * own_bad, k * own_lab
                out.append(number)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("host", "tmpl", "rest", "lab", "bad")), pa.array(out, pa.int64())], names=["host", "tmpl", "rest", "lab", "bad", "cluster"])

    return clusters


def sibling_labels(child: DataFrame, z: float) -> DataFrame:
    """child(host, tmpl, seg, rest, lab, bad) -> (host, tmpl, seg, label): siblings with the same usual rest of the path are clustered in order of bad rate.

    Siblings with the same counts cannot differ and are one bin. The label of more than two segments names the first, the last and how many more.
    """
    bins = child.groupBy("host", "tmpl", "rest", "lab", "bad").agg(F.count(F.lit(1)).alias("k"))
    rate = (F.col("bad") + 0.5) / (F.col("lab") + 1)
    sorted_ = bins.repartition("host", "tmpl", "rest").sortWithinPartitions("host", "tmpl", "rest", rate, "lab")
    numbered = sorted_.mapInArrow(_clusters(z), "host string, tmpl string, rest string, lab long, bad long, cluster long")
    of = materialize(child.join(numbered, ["host", "tmpl", "rest", "lab", "bad"]).select("host", "tmpl", "seg", "rest", "cluster"), "url-clusters")
    cluster = of.groupBy("host", "tmpl", "rest", "cluster").agg(F.count(F.lit(1)).alias("k"), F.min("seg").alias("lo"), F.max("seg").alias("hi"), F.max(F.col("seg") == "*").alias("star"))
    label = F.when(F.col("star"), "*").when(F.col("k") == 1, F.col("lo")).when(F.col("k") == 2, F.concat_ws("|", "lo", "hi")).otherwise(F.concat("lo", F.lit("|"), "hi", F.lit("|+"), (F.col("k") - 2).cast("string")))
    return of.join(cluster.select("host", "tmpl", "rest", "cluster", label.alias("label")), ["host", "tmpl", "rest", "cluster"]).select("host", "tmpl", "seg", "label")


def build_templates(urls: DataFrame, settings: TemplateSettings = TemplateSettings()) -> DataFrame:
    """urls(host, segs, bad: 1, 0 or null) -> (host, segs, template, labelled, bad, purity, block), one row a path shape."""
    s = settings
    state = urls.groupBy("host", "segs").agg(F.count(F.lit(1)).alias("n"), F.count("bad").alias("lab"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    stats = [F.sum("n").alias("n"), F.sum("lab").alias("lab"), F.sum("bad").alias("bad")]
    columns = ["host", "segs", "n", "lab", "bad", "tmpl"]
    done, open_ = [], materialize(state.select("*", F.lit("").alias("tmpl"), F.col("segs").alias("left")), "url-shapes")
    while True:  # one round a level at which open nodes branch
        here = open_.filter(F.size("left") > 0)
        done.append(open_.filter(F.size("left") == 0).select(columns))
        nodes = here.groupBy("host", "tmpl").agg(F.sum("n").alias("total"), F.min("left").alias("lo"), F.max("left").alias("hi"))
        differ = F.array_position(F.zip_with("lo", "hi", lambda a, b: a.eqNullSafe(b)), False)  # what the lowest and the highest share, all share
        nodes = nodes.select("host", "tmpl", "total", F.when(differ == 0, F.size("lo")).otherwise(differ - 1).cast("int").alias("same"))
        at = salted_left_join(here, nodes, ["host", "tmpl"], F.xxhash64("segs"))
        rare = F.col("total") < s.min_support
        head = F.when(rare, F.repeat(F.lit("/*"), F.size("left"))).otherwise(F.concat_ws("", F.transform(F.slice("left", F.lit(1), F.col("same")), lambda x: F.concat(F.lit("/"), x))))
        after = F.when(rare, F.slice("left", 1, 0)).otherwise(F.slice("left", F.col("same") + 1, F.size("left")))
        moved = materialize(at.select(*columns[:-1], F.concat("tmpl", head).alias("tmpl"), after.alias("left")), "url-moved")
        done.append(moved.filter(F.size("left") == 0).select(columns))
        if len(done) > 16:
            done = [materialize(reduce(DataFrame.unionByName, done), "url-done")]
        deep = moved.filter(F.size("left") > 0).withColumn("seg", F.col("left")[0]).withColumn("left", F.slice("left", F.lit(2), F.size("left")))
        if deep.isEmpty():
            break
        by_rest = deep.groupBy("host", "tmpl", "seg", F.array_join("left", "/").alias("rest")).agg(*stats)
        child = by_rest.groupBy("host", "tmpl", "seg").agg(F.max_by("rest", F.struct("n", "rest")).alias("rest"), *stats)
        labels = materialize(sibling_labels(child.filter(F.col("n") >= s.min_support), s.merge_z), "url-labels")
        grown = F.concat("tmpl", F.lit("/"), F.coalesce("label", F.lit("*")))
        open_ = materialize(salted_left_join(deep, labels, ["host", "tmpl", "seg"], F.xxhash64("segs")).select(*columns[:-1], grown.alias("tmpl"), "left"), "url-level")
    state = materialize(reduce(DataFrame.unionByName, done), "url-done")
    tmpl = state.groupBy("host", "tmpl").agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad"))
    host = tmpl.groupBy("host").agg(F.sum("lab").alias("hlab"), F.sum("bad").alias("hbad"))
    all_lab, all_bad = tmpl.agg(F.coalesce(F.sum("lab"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    overall = (all_bad + 0.5) / (all_lab + 1.0) if all_lab else 0.0
    host_rate = (F.col("hbad") + s.prior_weight * overall) / (F.col("hlab") + s.prior_weight)
    purity = (F.col("bad") + s.prior_weight * host_rate) / (F.col("lab") + s.prior_weight)
    judged = salted_left_join(tmpl, host, ["host"], F.xxhash64("tmpl")).select("host", "tmpl", F.col("lab").alias("labelled"), purity.alias("purity"), (purity >= s.block_at).alias("block"))
    return salted_left_join(state.select("host", "tmpl", "segs"), judged, ["host", "tmpl"], F.xxhash64("segs")).withColumnRenamed("tmpl", "template")


def judge_urls(pages: DataFrame, rules: list[Rule], labels: DataFrame | None = None, settings: TemplateSettings = TemplateSettings()) -> DataFrame:
    """pages(page_id, url) with host, path, rule, verdict, template and purity. labels: (page_id, bad), one row a page."""
    rows = pages.select("page_id", F.col("url").alias("_url")).select("page_id", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    rows = rows.withColumn("segs", segments_of(F.col("path")))
    marked = rows.withColumn("bad", F.lit(None).cast("int")) if labels is None else rows.join(labels.select("page_id", "bad"), "page_id", "left")
    templates = materialize(build_templates(marked.select("host", "segs", "bad"), settings), "url-templates")
    out = salted_left_join(rows, templates, ["host", "segs"], F.xxhash64("page_id", "path"))
    name, action = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(action, F.when(F.col("block"), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", name.alias("rule"), verdict.alias("verdict"), "template", "purity")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: a page's url ends in the id of the document it shows; that document's quality label is the page's."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", (1 - F.col("quality")).alias("bad")).groupBy("doc_id").agg(F.max("bad").alias("bad"))
    shown = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:\.html)?/?$", 1)
    known = pages.select("page_id", F.when(shown != "", shown.cast("long")).alias("doc_id")).join(labels, "doc_id").groupBy("page_id").agg(F.max("bad").alias("bad"))
    return judge_urls(pages, RULES, known)
