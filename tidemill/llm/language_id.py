"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts are made on the executors and summed by Spark; the matrix of log probabilities (languages x
buckets, at most CELLS numbers: the more languages, the fewer buckets) goes to every task, which scores
whole texts sparsely in numpy.

The model is fitted on a bounded sample of labelled rows (fit_rows, chosen by a hash of the id).
The score is the posterior of the predicted language at a likelihood tempered to `evidence` n-grams.

Cases: a null text or one without a letter is `und` with score 0; null labels and null ids are not
learned from; without any learnable row every text is `und`; rows repeated are scored alike; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_sample, slices, texts_of

BUCKET_BITS = 16
ORDERS = (1, 2, 3)
FIT_ROWS = 20_000
CELLS = 1 << 24  # of the broadcast matrix: 64 MB
ALPHA = 0.1
EVIDENCE = 60.0
CHUNK_BYTES = 1 << 20
_PAD = max(ORDERS) - 1


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def ngram_buckets(texts: list[str], bits: int = BUCKET_BITS) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order the bucket of the n-gram that begins at each place; and where each text's n-grams begin (and all end)."""
    pad = "\0" * _PAD
    low = [t.lower() for t in texts]
    chars = np.frombuffer((pad + pad.join(low) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.cumsum([0, *(len(t) + _PAD for t in low)])
    out, n = [], int(at[-1])
    key = np.zeros(n, np.uint32)
    for order in range(1, max(ORDERS) + 1):
        key = (key ^ chars[order - 1 : order - 1 + n]) * np.uint32(0x9E3779B1)
        key ^= key >> np.uint32(15)
        if order in ORDERS:
            out.append((key * np.uint32(0x85EBCA6B + 2 * order)) >> np.uint32(32 - bits))
    return out, at


@dataclass
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  # languages x buckets, float32
    log_prior: np.ndarray
    bits: int = BUCKET_BITS

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not texts or not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        orders, at = ngram_buckets(texts, self.bits)
        total = np.zeros((len(self.languages), len(texts)))
        for keys in orders:
            for k in range(len(self.languages)):
                total[k] += np.add.reduceat(self.log_prob[k][keys], at[:-1], dtype=np.float64)
        n = np.diff(at) * len(orders)
        tempered = total * np.minimum(1.0, EVIDENCE / n) + self.log_prior[:, None]
        tempered -= tempered.max(0)
        share = np.exp(tempered)
        share /= share.sum(0)
        best = tempered.argmax(0)
        known = [any(map(str.isalpha, t)) for t in texts]
        return [self.languages[b] if k else "und" for b, k in zip(best, known, strict=True)], np.where(known, share[best, np.arange(len(texts))], 0.0)


def fit_language_model(docs: DataFrame, fit_rows: int = FIT_ROWS) -> LanguageModel:
    """docs(id, text, lang): learns from rows whose text and lang are not null. There cannot be more languages than rows of the sample."""
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = rows.filter(in_sample(F.col("id"), fit_rows, rows.count()))
    priors = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by("lang")  # at most fit_rows rows, or so
    names = priors.column("lang").to_pylist()
    bits = min(BUCKET_BITS, (CELLS // max(len(names), 1)).bit_length() - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK_BYTES):
            texts, langs = texts_of(batch.column("text")).to_pylist(), batch.column("lang").to_pylist()
            orders, at = ngram_buckets(texts, bits)
            place = {x: k for k, x in enumerate(dict.fromkeys(langs))}
            row = np.repeat(np.array([place[x] for x in langs], np.int64) << bits, np.diff(at))
            cell, n = np.unique(np.concatenate([row + keys for keys in orders]), return_counts=True)
            own = list(place)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([own[k] for k in (cell >> bits).tolist()], pa.string()), "bucket": pa.array(cell & ((1 << bits) - 1)), "n": pa.array(n.astype(np.int64))})

    sums = rows.select("text", "lang").mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = sums.toArrow()  # at most CELLS rows
    place = {x: k for k, x in enumerate(names)}
    counts = np.full((len(names), 1 << bits), ALPHA)
    if table.num_rows:
        lang = table.column("lang").combine_chunks().dictionary_encode()
        lang = lang.combine_chunks() if isinstance(lang, pa.ChunkedArray) else lang
        at = np.array([place[x] for x in lang.dictionary.to_pylist()], np.int64)[lang.indices.to_numpy()]
        counts[at, table.column("bucket").to_numpy()] += table.column("n").to_numpy()
    prior = priors.column("n").to_numpy().astype(float)
    return LanguageModel(names, np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32), np.log(prior / max(prior.sum(), 1)), bits)


def identify_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """docs(id, held_out, text) -> id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK_BYTES):
            langs, scores = shared.value.score(texts_of(batch.column("text")).to_pylist())
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "held_out": batch.column("held_out"), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())})

    return docs.select(F.col("id").cast("long"), "held_out", "text").mapInArrow(score, "id long, held_out boolean, lang_pred string, score double")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), "text", "lang").withColumn("held_out", is_held_out(F.col("id")))
    model = fit_language_model(docs.filter(~F.col("held_out") & F.col("id").isNotNull()))
    return identify_languages(docs, model).withColumnRenamed("id", "doc_id")
