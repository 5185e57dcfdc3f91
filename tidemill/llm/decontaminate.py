"""Benchmark decontamination by a BM25 index of the test items.

Each training text is cut into overlapping passages, and every passage queries the index for all items
whose BM25 score reaches `threshold` of the item's score for itself. The index is an inverted one with
block maxima: for each term and block of items the highest weight that the term can add. WAND's pivot is
taken for each block: with the block's terms in order, the commonest first, those before the pivot cannot reach
half the threshold together, so only terms from there on open the block, and long postings are hardly
ever walked. A (passage, block) whose bound, the maxima of the terms that opened it and what those before the pivot can add,
stays under the threshold is dropped; in the others the passage's terms are looked up and scored exactly. This
runs as array work for many passages at once, in steps of bounded size. A hit is verified: of the item's question
and of its answer (its last line or sentence), the share of five-word shingles that the text holds must reach
`overlap`.

The index is broadcast in shards of bounded bytes, each scanned in turn, so any benchmark size works.

Cases: null or empty texts and items without words never match; a score equal to the threshold is a hit, and a text is
reported once with each item, by its best passage; a null id is reported as null; repeated
rows are reported each; very long items are indexed in pieces; empty tables give an empty result;
other columns pass unchanged through remove_contaminated().
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, released, slices, sorted_unique, span_hashes, texts_of, utf8

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, WIDTH = 0.5, 0.6, 5
PIECE_WORDS = 96  # longer items are indexed in pieces
BLOCK_ITEMS = 4
SHARD_BYTES = 4 << 20
CHUNK_BYTES = 512 << 10
STEP = 1 << 19  # postings that are opened, or looked up, at once
HITS = "id long, item_id long, score double, question_overlap double, answer_overlap double"
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def plain_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters, digits and bytes of other characters) of lower-cased texts, and how many come before each text."""
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    here, before = np.append(inside, False), np.concatenate([[False], inside])
    starts, ends = np.flatnonzero(here & (~before | edge)), np.flatnonzero(before & (~here | edge))
    return span_hashes(data, starts, ends), np.searchsorted(starts, at)


def hashed_words(text: str) -> np.ndarray:
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    return plain_words(data, np.array([0, len(data)]))[0]


def shingles(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hashes of the shingles of a word sequence; a shorter one is a single shingle of its own width."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    return mix(h)


def _share(wanted: np.ndarray, held: np.ndarray) -> float:
    """The share of wanted values among the sorted ones; 1 of none."""
    if not len(wanted):
        return 1.0
    return float((held[np.minimum(np.searchsorted(held, wanted), len(held) - 1)] == wanted).mean()) if len(held) else 0.0


def split_item(text: str) -> tuple[str, str]:
    """(question, answer): the answer is the last line, or the last sentence of a single line; a single sentence has no answer."""
    lines = [x for x in text.split("\n") if x.strip()]
    if len(lines) > 1:
        return "\n".join(lines[:-1]), lines[-1]
    parts = [x for x in re.split(r"(?<=[.!?])\s+", text.strip()) if x]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


@dataclass
class ItemIndex:
    """A shard of items. Pieces of items are numbered in order; blocks are runs of BLOCK_ITEMS pieces; a slot is a term in a block."""

    items: list[tuple[int, str]]
    threshold: float = THRESHOLD
    vocab: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))

    def __post_init__(self) -> None:
        words = [hashed_words(t or "") for _, t in self.items]
        self.parts = [tuple(hashed_words(x) for x in split_item(t or "")) for _, t in self.items]
        flat = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.span = 1
        if not len(flat):
            return
        counts = np.array([len(w) for w in words])
        pieces = -(-counts // PIECE_WORDS)
        base = np.cumsum(pieces) - pieces
        self.ids = np.repeat(np.arange(len(words)), pieces)  # of each piece, the item's number
        place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
        piece = np.repeat(base, counts) + place // PIECE_WORDS
        size = np.bincount(piece)
        self.span = int(size.max())
        self.vocab, term = np.unique(flat, return_inverse=True)
        n, self.blocks = len(size), -(-len(size) // BLOCK_ITEMS)
        key, tf = np.unique(term * n + piece, return_counts=True)  # postings by term, then piece
        term, self.item = np.divmod(key, n)
        found = np.bincount(term)
        idf = np.log(1 + (n - found + 0.5) / (found + 0.5))
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[self.item] / size.mean()))
        self.weight = weight / np.bincount(self.item, weight)[self.item]  # as a share of the piece's own score
        self.slot, at = np.unique(term * self.blocks + self.item // BLOCK_ITEMS, return_index=True)
        self.posts = np.append(at, len(key))  # postings of a slot: posts[k] to posts[k + 1]
        most = np.maximum.reduceat(self.weight, at)
        own, block = np.divmod(self.slot, self.blocks)
        common = np.bincount(own)
        order = np.lexsort((own, -common[own], block))
        so_far = np.cumsum(most[order])
        starts = np.searchsorted(block[order], np.arange(self.blocks))
        so_far -= (so_far[starts] - most[order][starts])[block[order]]
        opens = np.empty(len(own), bool)
        opens[order] = so_far > self.threshold / 2
        self.rest = np.bincount(block[~opens], most[~opens], minlength=self.blocks)  # what terms before the pivot can add
        self.begin = np.searchsorted(own[opens], np.arange(len(self.vocab) + 1))
        self.block, self.most = block[opens], most[opens]

    def hits(self, words: np.ndarray, first: np.ndarray, overlap: float) -> list[tuple[int, int, float, float, float]]:
        """(text, item, score, question overlap, answer overlap) of texts whose word hashes stand one after another."""
        if not len(self.vocab) or not len(words):
            return []
        term = np.minimum(np.searchsorted(self.vocab, words), len(self.vocab) - 1)
        at = np.flatnonzero(self.vocab[term] == words)
        term = term[at]
        text = np.searchsorted(first, at, "right") - 1
        windows = -(-np.diff(first) // self.span)
        base = np.concatenate([[0], np.cumsum(windows)])
        place = (at - first[text]) // self.span
        window = base[text] + place  # a passage is two spans long: words of span k are in passages k and k - 1
        key = sorted_unique(np.concatenate([window, window[place > 0] - 1]) * len(self.vocab) + np.concatenate([term, term[place > 0]]))
        window, term = np.divmod(key, len(self.vocab))
        n = self.begin[term + 1] - self.begin[term]
        ends = np.flatnonzero(np.append(window[1:] != window[:-1], True)) + 1  # passages whole
        work = np.cumsum(n)
        out: dict[tuple[int, int], float] = {}
        a = 0
        while a < len(window):
            done = work[a - 1] if a else 0
            k = int(np.searchsorted(work[ends - 1], done + STEP, "right"))
            b = int(ends[max(k - 1, int(np.searchsorted(ends, a, "right")))])
            self._score(window[a:b], term[a:b], n[a:b], base, out)
            a = b
        sure, last, held = [], -1, {}
        for (d, i), score in sorted(out.items()):
            if d != last:
                last, held = d, {}
            for p in self.parts[i]:
                if min(WIDTH, len(p)) not in held:
                    held[min(WIDTH, len(p))] = sorted_unique(shingles(words[first[d] : first[d + 1]], min(WIDTH, len(p))))
            q, x = (_share(shingles(p), held[min(WIDTH, len(p))]) for p in self.parts[i])
            if q >= overlap and x >= overlap:
                sure.append((d, i, min(score, 1.0), q, x))
        return sure

    def _score(self, window: np.ndarray, term: np.ndarray, n: np.ndarray, base: np.ndarray, out: dict[tuple[int, int], float]) -> None:
        """Adds the items that reach the threshold in these passages, given as their distinct terms."""
        post = np.repeat(self.begin[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
        pair, where = np.unique(np.repeat(window, n) * self.blocks + self.block[post], return_inverse=True)
        bound = np.bincount(where, self.most[post], minlength=len(pair))
        likely = pair[bound + self.rest[pair % self.blocks] >= self.threshold - 1e-9]
        begin = np.searchsorted(window, likely // self.blocks)
        size = np.searchsorted(window, likely // self.blocks, "right") - begin
        at = 0
        for stop in [*np.flatnonzero(np.diff(np.cumsum(size) // STEP)).tolist(), len(likely) - 1] if len(likely) else []:
            some = slice(at, stop + 1)
            at = stop + 1
            w, b = np.divmod(likely[some], self.blocks)
            m = size[some]
            which = np.repeat(np.arange(len(w)), m)
            slot = term[np.repeat(begin[some] - np.cumsum(m) + m, m) + np.arange(m.sum())] * self.blocks + b[which]
            seek = np.minimum(np.searchsorted(self.slot, slot), len(self.slot) - 1)
            known = self.slot[seek] == slot
            which, seek = which[known], seek[known]
            c = self.posts[seek + 1] - self.posts[seek]
            post = np.repeat(self.posts[seek] - np.cumsum(c) + c, c) + np.arange(c.sum())
            cell = np.repeat(which, c) * BLOCK_ITEMS + self.item[post] % BLOCK_ITEMS
            score = np.bincount(cell, self.weight[post], minlength=len(w) * BLOCK_ITEMS)
            for x in np.flatnonzero(score >= self.threshold - 1e-9).tolist():
                k, i = divmod(x, BLOCK_ITEMS)
                key = (int(np.searchsorted(base, w[k], "right")) - 1, int(self.ids[int(b[k]) * BLOCK_ITEMS + i]))
                out[key] = max(out.get(key, 0.0), float(score[x]))

    def search(self, texts: list[str], overlap: float = OVERLAP) -> list[tuple[int, int, float, float, float]]:
        low = pa.array([t.lower() for t in texts], pa.large_string())
        return self.hits(*plain_words(*utf8(low)), overlap)


def index_shards(benchmark: DataFrame, shard_bytes: int = SHARD_BYTES, threshold: float = THRESHOLD) -> Iterator[ItemIndex]:
    """The index of benchmark(item_id, text), a shard of bounded bytes at a time."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-int(total) // shard_bytes))
    for k in range(shards):
        own = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k) if shards > 1 else rows
        yield ItemIndex(sorted(((r.item_id, r.text) for r in own.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1])), threshold)


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """docs(id, text) x benchmark(item_id, text) -> one row a text and item it contains."""
    spark, out = docs.sparkSession, None
    for index in index_shards(benchmark, shard_bytes, threshold):
        shared = spark.sparkContext.broadcast(index)

        def look(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", CHUNK_BYTES):
                found = shared.value.search(texts_of(batch.column("text")).to_pylist(), overlap)
                ids = batch.column("id").to_pylist()
                cols = list(zip(*[(ids[d], shared.value.items[i][0], s, q, a) for d, i, s, q, a in found])) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 2 + [pa.float64()] * 3, strict=True)], names=["id", "item_id", "score", "question_overlap", "answer_overlap"])

        part = docs.select(F.col("id").cast("long").alias("id"), "text").mapInArrow(look, HITS)
        out = part if out is None else out.unionByName(part)
    return out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """docs without the texts that contain a test item, all columns as they are; one narrow pass a shard."""
    for index in index_shards(benchmark, threshold=threshold):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text_col, CHUNK_BYTES):
                keep = np.ones(batch.num_rows, bool)
                keep[[d for d, *_ in shared.value.search(texts_of(batch.column(text_col)).to_pylist(), overlap)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(released(clean), docs.schema)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    return contaminated_pairs(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).withColumnRenamed("id", "doc_id")
