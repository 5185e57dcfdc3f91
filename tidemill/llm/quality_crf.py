"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad. Its features are binned measures of the line and of the lines
before and after it; two transition weights tie neighbours. Forward-backward marginals of `good`,
weighted by line length, give the document's quality, which a logistic curve fitted on the
training rows turns into the score.

The field is fitted on a bounded sample: about fit_rows labelled documents chosen by a hash of the id, fewer
where these have more than fit_lines lines in all; a document of any length may be chosen, as long as it
has no more lines than are left, and its label counts for all its lines. Scoring reads whole texts.

Cases: a null text is empty; an empty text is one empty line; very long texts are scored whole, line
by line; null labels and null ids are not learned from; without both labels in the sample every score
is 0.5 and nothing is rejected; repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_sample, lowered, released, slices, span_hashes, utf8, words_of
from .language_id import is_held_out

FIT_ROWS, FIT_LINES = 4000, 400_000
ROUNDS, STEP, L2 = 120, 0.3, 1e-4
REJECT_BELOW = 0.3
CHUNK_BYTES = 1 << 20
BINS = 8
MEASURES = 12

_KIND = np.zeros((5, 256), np.int64)  # capitals, digits, signs, pipes, letters (ASCII, and bytes of other characters)
_KIND[0, 65:91] = 1
_KIND[1, 48:58] = 1
_KIND[2, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
_KIND[3, ord("|")] = 1
_KIND[4, [*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_EDGES = np.array([0.001, 0.02, 0.06, 0.12, 0.25, 0.5, 0.8])
_COUNT_EDGES = np.array([1, 3, 6, 10, 20, 40, 100])


def line_features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins: lines x MEASURES, bytes of each line, where each text's lines begin and all end)."""
    n = len(data)
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([at[:-1], breaks + 1]))  # a break at a text's end opens an empty last line
    first = np.searchsorted(breaks, at) + np.arange(len(at))
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    ends[first[1:] - 1] = at[1:]
    size = ends - starts
    sums = np.zeros((5, n + 1), np.int64)
    for k in range(5):
        np.cumsum(_KIND[k][data], out=sums[k, 1:])
    caps, digits, signs, pipes, letters = sums[:, ends] - sums[:, starts]
    ws, we, _ = words_of(data, np.unique(np.concatenate([starts, at])))
    words = np.searchsorted(ws, ends) - np.searchsorted(ws, starts)
    line = np.searchsorted(starts, ws, "right") - 1
    h = span_hashes(lowered(data), ws, we)
    same = np.zeros(len(starts), np.int64)
    if len(ws) > 1:
        np.add.at(same, line[1:][(h[1:] == h[:-1]) & (line[1:] == line[:-1])], 1)
    order = np.lexsort((h, line))
    fresh = np.ones(len(ws), bool)
    fresh[1:] = (line[order][1:] != line[order][:-1]) | (h[order][1:] != h[order][:-1])
    distinct = np.bincount(line[order][fresh], minlength=len(starts))
    tails = data[np.maximum(we - 1, 0)]
    tail_sign = np.bincount(line, weights=_KIND[2][tails] * (we - ws > 1), minlength=len(starts))
    lone_sign = np.bincount(line, weights=_KIND[2][tails] * (we - ws == 1), minlength=len(starts))
    some, per_word = np.maximum(size, 1), np.maximum(words, 1)
    last = np.where(size > 0, data[np.maximum(ends - 1, 0)] if n else 0, 0)
    shares = [caps / np.maximum(letters, 1), digits / some, signs / some, pipes / per_word, same / per_word, 1 - distinct / per_word, tail_sign / per_word, lone_sign / per_word, letters / some]
    bins = np.empty((len(starts), MEASURES), np.int64)
    for k, x in enumerate(shares):
        bins[:, k] = np.searchsorted(_EDGES, x, "right")
    bins[:, 9] = np.searchsorted(_COUNT_EDGES, words, "right")
    bins[:, 10] = np.searchsorted(_COUNT_EDGES, size / per_word, "right")
    bins[:, 11] = np.where(size == 0, 0, np.where(np.isin(last, [33, 46, 63]), 1, np.where(_KIND[2][last] > 0, 2, 3)))
    return bins, size, first


def with_neighbours(bins: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Feature numbers of every line: its own bins and those of the lines before and after it in its text."""
    width = MEASURES * (BINS + 1)
    own = bins + np.arange(MEASURES) * (BINS + 1)
    edge = np.arange(MEASURES) * (BINS + 1) + BINS  # no such line
    before, after = np.empty_like(own), np.empty_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first[:-1]], after[first[1:] - 1] = edge, edge
    return np.concatenate([own, before + width, after + 2 * width], axis=1)


N_FEATURES = 3 * MEASURES * (BINS + 1)


def _forward_backward(emit: np.ndarray, first: np.ndarray, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of good, and of two neighbours both good / both bad (lines x 2; the first line of a text has none).

    emit: log-odds of good of each line; stay: weights of good-good and bad-bad. All texts move on together, longest first.
    """
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    start, counts = first[:-1][order], counts[order]
    longest = int(counts[0]) if len(counts) else 0
    alive = np.searchsorted(-counts, -np.arange(1, longest + 1), "right")
    fwd, back = np.zeros(len(emit)), np.zeros(len(emit))  # log-odds of messages
    g, b = stay
    step = lambda r: np.logaddexp(r + g, 0) - np.logaddexp(r, b)
    for t in range(longest):
        at = start[: alive[t]] + t
        fwd[at] = emit[at] + (step(fwd[at - 1]) if t else 0)
    for t in range(longest - 2, -1, -1):
        at = start[: alive[t + 1]] + t
        back[at] = step(emit[at + 1] + back[at + 1])
    good = 1 / (1 + np.exp(-np.clip(fwd + back, -500, 500)))
    pairs = np.zeros((len(emit), 2))
    later = np.ones(len(emit), bool)
    later[first[:-1]] = False
    at = np.flatnonzero(later)
    left, right = fwd[at - 1], emit[at] + back[at]
    logs = np.stack([left + right + g, left, right, np.full(len(at), float(b))])
    logs -= logs.max(0)
    p = np.exp(logs)
    p /= p.sum(0)
    pairs[at, 0], pairs[at, 1] = p[0], p[3]
    return good, pairs


@dataclass
class QualityModel:
    weights: np.ndarray | None
    stay: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def document_odds(self, bins: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        emit = self.weights[with_neighbours(bins, first)].sum(1)
        good, _ = _forward_backward(emit, first, self.stay)
        weight = size + 1.0
        share = np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])
        share = np.clip(share, 1e-4, 1 - 1e-4)
        return np.log(share / (1 - share))

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        if self.weights is None or len(at) < 2:
            return np.full(len(at) - 1, 0.5)
        return 1 / (1 + np.exp(-(self.slope * self.document_odds(*line_features(data, at)) + self.shift)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    w = np.array([1.0, 0.0])
    X = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        grad = X.T @ (p - y) + 0.01 * (w - [1.0, 0.0])
        hess = (X * (p * (1 - p))[:, None]).T @ X + 0.01 * np.eye(2)
        w -= np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(w[0]), float(w[1])


def train(bins: np.ndarray, size: np.ndarray, first: np.ndarray, label: np.ndarray) -> QualityModel:
    """Gradient ascent (Adam) on the conditional likelihood of each document's label on all its lines; every document has equal weight."""
    if len(label) == 0 or label.min() == label.max():
        return QualityModel(None, np.zeros(2))
    counts = np.diff(first)
    y = np.repeat(label, counts).astype(float)
    share = 1 / np.repeat(counts, counts) / len(label)
    later = np.ones(len(y))
    later[first[:-1]] = 0
    ids = with_neighbours(bins, first)
    flat = ids.ravel()
    w, stay = np.zeros(N_FEATURES), np.array([0.5, 0.5])
    m, v = np.zeros(N_FEATURES + 2), np.zeros(N_FEATURES + 2)
    for r in range(1, ROUNDS + 1):
        good, pairs = _forward_backward(w[ids].sum(1), first, stay)
        slope = np.bincount(flat, np.repeat((y - good) * share, ids.shape[1]), minlength=N_FEATURES)
        ties = [(share * later * (y - pairs[:, 0])).sum(), (share * later * ((1 - y) - pairs[:, 1])).sum()]
        grad = np.concatenate([slope - L2 * w, np.array(ties) - 0.01 * stay])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = STEP * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-6) * min(1.0, 2 - 2 * r / ROUNDS)
        w, stay = w + move[:-2], np.clip(stay + move[-2:], -3, 3)
    model = QualityModel(w, stay)
    model.slope, model.shift = _logistic(model.document_odds(bins, size, first), label)
    model.slope = max(model.slope, 0.05)
    return model


def fit_quality_model(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_lines: int = FIT_LINES) -> QualityModel:
    """docs(doc_id, text), labels(doc_id, quality). The sample is chosen among the labels first, so few texts are moved.

    A document that occurs in several rows is learned from once. Documents are taken in the order of a hash of their ids; one that
    has more lines than are left of fit_lines is passed over, so however the rows lie, no more than both bounds comes to the driver.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    total = known.count()
    sampled = in_sample(F.col("doc_id"), fit_rows, total)
    texts = docs.filter(sampled).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("is", F.xxhash64("text"))
    lines = (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long")
    once = texts.select("doc_id", "is", lines.alias("lines")).groupBy("doc_id").agg(F.min(F.struct("is", "lines")).alias("x"))  # before the join: rows of one id are no more than one
    sizes = once.join(known.filter(sampled), "doc_id")
    chosen, left = [], fit_lines
    for r in sizes.orderBy(F.xxhash64("doc_id"), "doc_id").collect():  # ids and numbers of a sample of labels, one row a document
        if r.x["lines"] <= left:
            chosen.append((r.doc_id, r.x["is"], r.quality))
            left -= r.x["lines"]
    own = docs.sparkSession.createDataFrame(chosen, f"doc_id {known.schema['doc_id'].dataType.simpleString()}, is long, quality long")
    rows = texts.join(F.broadcast(own), ["doc_id", "is"]).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("text").alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK_BYTES):
            bins, size, first = line_features(*utf8(batch.column("text")))
            cut = [(int(a), int(b)) for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").cast(pa.int64()), "quality": batch.column("quality").cast(pa.int64()), "bins": pa.array([bins[a:b].astype(np.uint8).tobytes() for a, b in cut], pa.binary()), "size": pa.array([size[a:b].astype(np.int64).tobytes() for a, b in cut], pa.binary())})

    got = rows.select("doc_id", "quality", "text").mapInArrow(released(measure), "doc_id long, quality long, bins binary, size binary").toArrow().sort_by("doc_id")
    if not got.num_rows:
        return QualityModel(None, np.zeros(2))
    bins = [np.frombuffer(x, np.uint8).reshape(-1, MEASURES) for x in got.column("bins").to_pylist()]
    size = np.concatenate([np.frombuffer(x, np.int64) for x in got.column("size").to_pylist()])
    first = np.cumsum([0, *(len(x) for x in bins)])
    return train(np.concatenate(bins).astype(np.int64), size, first, got.column("quality").to_numpy())


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """docs with score and predicted (1 if score >= REJECT_BELOW); its other columns pass unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = docs.select(*rest).schema.add("score", "double").add("predicted", "integer")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, CHUNK_BYTES):
            s = shared.value.score(*utf8(batch.column(text_col)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64()), pa.array((s >= REJECT_BELOW).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])

    return docs.select(*rest).mapInArrow(released(score), schema)


def learnable(labels: DataFrame) -> DataFrame:
    return labels.filter(~is_held_out(F.col("doc_id"))).select("doc_id", "quality")


def op6_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_quality_model(docs, learnable(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    scored = score_quality(docs, model)
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
