"""Packing token sequences by vector bin packing with the dot-product heuristic.

A bin (a sequence) has three capacities: tokens, segments and loss-bearing tokens. Of the pending
pieces that fit, a bin takes the one with the highest dot product of its demand and what the bin has
left, each as a share of capacity. When none fits whole, one is cut to fill the bin. A bin that
must close before it is full, by its other limits or at the end of a task, is cut into
sequences whose lengths are powers of two, so that no sequence needs padding.

Every task packs its own texts: no shuffle, no key, and the memory of a task is bounded by the
pool of pending pieces. Sequence ids carry the task's number, so a repeated task gives the same ones.

Token ids are those of the tokenizer file. Texts of common scripts are cut into its pre-tokens by
array work and each distinct pre-token is encoded once; any other text, and any that holds an added
token such as <|endoftext|>, goes to the tokenizers library whole.

Cases: a null or empty text is the end id alone; null ids and repeated rows are ordinary rows; very long
texts take many sequences; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, released, slices, texts_of

END_ID = 1
CHUNK_BYTES = 512 << 10
CACHE_PIECES = 500_000
POOL = 512
_LIMIT = 0x2100


def _classes() -> np.ndarray:
    """0 letter, 1 number, 2 white space, 3 other, 4 leave to the library; by code point."""
    out = np.full(_LIMIT + 1, 4, np.uint8)
    for c in [*range(0x250), *range(0x370, 0x530), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x20C0)]:
        kind = unicodedata.category(chr(c))
        if kind != "Cn" and c not in range(0x1C, 0x20) and c != 0x85:
            out[c] = 0 if kind[0] == "L" else 1 if kind[0] == "N" else 2 if c in (9, 10, 11, 12, 13, 32, 0xA0) else 3
    return out


_CLASS = _classes()
_TERM = mix(np.arange(1, _LIMIT + 2, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_pow: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(_pow[0]) < n:
        for i, base in ((0, _BASE), (1, pow(_BASE, -1, 1 << 64))):
            x = np.full(max(n, 1 << 16), base, np.uint64)
            x[0] = 1
            _pow[i] = np.multiply.accumulate(x)
    return _pow[0][:n], _pow[1][:n]


def pretoken_starts(chars: np.ndarray, kind: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of texts begin. The rule of byte-level BPE: contractions; letters, numbers or others, with one space before; white space."""
    n = len(chars)
    start = np.zeros(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    start[at] = True
    edge = np.zeros(n + 2, bool)
    edge[at] = True
    last = np.flatnonzero((kind[:-1] == 2) & (kind[1:] != 2) & ~edge[1:n]) if n > 1 else np.zeros(0, np.int64)
    start[last] = True  # the last white space before something else stands alone ...
    start[last[chars[last] == 32] + 1] = False  # ... or, if a space, joins what follows
    quote = np.flatnonzero((chars == 39) & start[:n])
    if len(quote):
        ahead = lambda k: np.where((quote + k < n), chars[np.minimum(quote + k, n - 1)], 0)
        stop = at[np.searchsorted(at, quote, "right")]
        one = np.isin(ahead(1), [ord(c) for c in "stmd"]) & (quote + 1 < stop)
        two = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            two |= (ahead(1) == ord(a)) & (ahead(2) == ord(b)) & (quote + 2 < stop)
        for found, size in ((one, 2), (two, 3)):
            start[quote[found] + 1] = False
            start[quote[found] + size] = True
    return np.flatnonzero(start[:n])


class Encoder:
    """Token ids of texts as tokenizers gives them with add_special_tokens=False. Texts that hold an added token of the file go to the library."""

    def __init__(self, path: str) -> None:
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        vocab, special = whole["model"]["vocab"], {t["content"] for t in whole["added_tokens"]}
        self.added = sorted(special)
        letters = self._byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
        self.pieces = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.forget()

    @cached_property
    def library(self):
        """The tokenizers library's own, loaded when a text needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @staticmethod
    def _byte_letters() -> dict[str, int]:
        """The letter that byte-level BPE writes for each byte."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        out = {chr(b): b for b in shown}
        return out | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}

    def forget(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes of known pre-tokens in order, and their numbers
        self.begin, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0
        self.spelt, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)  # where the characters of each stand in letters
        self.letters, self.written = np.zeros(1 << 16, np.uint16), 0

    def _learn(self, keys: np.ndarray, place: np.ndarray, pieces: list[str]) -> None:
        encode = self.pieces._core_bpe.encode_ordinary
        found = [encode(piece) for piece in pieces]
        k, sizes = len(self.keys), np.fromiter(map(len, found), np.int64, len(found))
        total = int(sizes.sum())
        while k + len(keys) > len(self.begin):
            self.begin, self.size, self.spelt, self.length = (np.resize(x, 2 * len(x)) for x in (self.begin, self.size, self.spelt, self.length))
        if self.used + total > len(self.pool):
            self.pool = np.resize(self.pool, 2 * (self.used + total))
        self.begin[k : k + len(keys)] = self.used + np.cumsum(sizes) - sizes
        self.size[k : k + len(keys)] = sizes
        self.pool[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.int32, total)
        self.used += total
        chars = np.frombuffer("".join(pieces).encode("utf-16-le"), np.uint16)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        if self.written + len(chars) > len(self.letters):
            self.letters = np.resize(self.letters, 2 * (self.written + len(chars)))
        self.letters[self.written : self.written + len(chars)] = chars
        self.spelt[k : k + len(keys)], self.length[k : k + len(keys)] = self.written + np.cumsum(lengths) - lengths, lengths
        self.written += len(chars)
        self.slots = np.insert(self.slots, place, np.arange(k, k + len(keys)))
        self.keys = np.insert(self.keys, place, keys)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        whole = "".join(texts)
        if not whole:
            return [np.zeros(0, np.int32) for _ in texts]
        chars = np.frombuffer(whole.encode("utf-32-le"), np.uint32).astype(np.intp)
        kind = _CLASS.take(chars, mode="clip")
        at = np.cumsum([0, *map(len, texts)])
        rare = np.flatnonzero(kind == 4)
        odd = set((np.searchsorted(at, rare, "right") - 1).tolist())
        if any(a in whole for a in self.added):
            odd |= {i for i, t in enumerate(texts) if any(a in t for a in self.added)}
        if odd:
            rest = iter(self.encode([t for i, t in enumerate(texts) if i not in odd]))
            return [self._by_library(t) if i in odd else next(rest) for i, t in enumerate(texts)]
        starts = pretoken_starts(chars, kind, at)
        ends = np.append(starts[1:], len(chars))
        up, down = _powers(len(chars) + 1)
        total = np.zeros(len(chars) + 1, np.uint64)
        np.cumsum(_TERM.take(chars) * up[: len(chars)], out=total[1:])
        key = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        distinct, one, back = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_PIECES:
            self.forget()
        place = np.searchsorted(self.keys, distinct)
        new = np.flatnonzero(self.keys[np.minimum(place, len(self.keys) - 1)] != distinct) if len(self.keys) else np.arange(len(distinct))
        if len(new):
            cuts = zip(starts[one[new]].tolist(), ends[one[new]].tolist(), strict=True)
            self._learn(distinct[new], place[new], [whole[a:b] for a, b in cuts])
            place = np.searchsorted(self.keys, distinct)
        slot = self.slots[place][back]
        # a pre-token whose characters are not those that its number was learned from (equal hashes) sends its text to the library
        spans = np.where(self.length[slot] == ends - starts, self.spelt[slot] - starts, 0)
        same = self.letters.take(np.repeat(spans, ends - starts) + np.arange(len(chars)), mode="clip") == chars
        wrong = np.unique(np.searchsorted(at, np.flatnonzero(~same), "right") - 1) if not same.all() else np.zeros(0, np.int64)
        wrong = np.union1d(wrong, np.searchsorted(at, starts[self.length[slot] != ends - starts], "right") - 1).tolist()
        size = self.size[slot]
        stop = np.cumsum(size)
        ids = self.pool[np.repeat(self.begin[slot] - stop + size, size) + np.arange(stop[-1])]
        cut = np.append(0, stop)[np.searchsorted(starts, at)]
        out = [ids[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        for i in wrong:
            out[i] = self._by_library(texts[i])
        return out

    def _by_library(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


@dataclass
class Piece:
    doc: object  # whatever identifies the example
    start: int
    ids: np.ndarray
    loss_from: int  # tokens of the example from here on bear loss
    total: int

    def loss(self, n: int) -> int:
        """Loss-bearing tokens among the first n."""
        return max(0, self.start + n - max(self.loss_from, self.start))

    def longest(self, loss: int) -> int:
        """How many tokens can be taken with at most so many loss-bearing ones."""
        return min(len(self.ids), max(0, self.loss_from - self.start) + loss)

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.loss_from, self.total), Piece(self.doc, self.start + n, self.ids[n:], self.loss_from, self.total)


class Packer:
    """Feed examples with add(); every result is a closed sequence: a list of pieces in order."""

    def __init__(self, limits: Limits = Limits(), pool: int = POOL) -> None:
        self.limits, self.most = limits, pool
        self.pool: list[Piece] = []
        self.demand = np.zeros((0, 3))

    def _share(self, p: Piece) -> tuple[float, float, float]:
        x = self.limits
        return len(p.ids) / x.tokens, 1 / x.segments, p.loss(len(p.ids)) / max(x.loss, 1)

    def add(self, doc: object, ids: np.ndarray, loss_from: int = 0) -> Iterator[list[Piece]]:
        x, piece = self.limits, Piece(doc, 0, ids, loss_from, len(ids))
        while len(piece.ids) >= x.tokens and piece.loss(x.tokens) <= x.loss:  # a full sequence of its own
            one, piece = piece.cut(x.tokens)
            yield [one]
        while piece.loss(len(piece.ids)) > x.loss or len(piece.ids) >= x.tokens:  # no piece may break a limit by itself
            one, piece = piece.cut(min(piece.longest(x.loss), x.tokens))
            self.pool.append(one)
        if len(piece.ids):
            self.pool.append(piece)
        if len(self.pool) >= self.most:
            yield from self._pack(self.most // 2)

    def finish(self) -> Iterator[list[Piece]]:
        yield from self._pack(0)

    def _pack(self, until: int) -> Iterator[list[Piece]]:
        x = self.limits
        limit = np.array([x.tokens, x.segments, max(x.loss, 1)], float)
        pool = self.pool
        demand = np.array([self._share(p) for p in pool]).reshape(-1, 3)  # > 0 in tokens
        size, free = np.array([len(p.ids) for p in pool], int), np.array([max(0, p.loss_from - p.start) for p in pool], int)
        alive = np.ones(len(pool), bool)
        while alive.sum() > until:
            bin_: list[Piece] = []
            left = np.ones(3)
            while True:
                fits = alive & (demand[:, 0] <= left[0] + 1e-9) & (demand[:, 2] <= left[2] + 1e-9) if left[1] > 1e-9 else alive[:0]
                if fits.any():  # every piece asks for the same share of segments, so that term can stay out of the comparison
                    k = int((fits * (demand[:, 0] * left[0] + demand[:, 2] * left[2])).argmax())
                    bin_.append(pool[k])
                    alive[k] = False
                    left = left - demand[k]
                    continue
                room = np.rint(left * limit).astype(int)
                takes = np.where(alive, np.minimum(np.minimum(size, free + room[2] * (x.loss > 0)), room[0] * (room[1] > 0)), 0)
                k = int(takes.argmax()) if len(takes) else 0
                if not len(takes) or takes[k] <= 0:
                    break
                one, pool[k] = pool[k].cut(int(takes[k]))
                bin_.append(one)
                left = left - np.array(self._share(one))
                if len(pool[k].ids):
                    demand[k], size[k], free[k] = self._share(pool[k]), len(pool[k].ids), max(0, pool[k].loss_from - pool[k].start)
                else:
                    alive[k] = False
            yield from self._close(bin_)
        self.pool = [p for p, a in zip(pool, alive, strict=True) if a]

    def _close(self, pieces: list[Piece]) -> Iterator[list[Piece]]:
        """Full sequences as they are, others as sequences whose lengths are powers of two."""
        total = sum(len(p.ids) for p in pieces)
        if total == self.limits.tokens:
            yield pieces
            return
        pieces = list(pieces)
        while total:
            room = 1 << (total.bit_length() - 1)
            total -= room
            out = []
            while room:
                p = pieces.pop(0)
                if len(p.ids) > room:
                    p, rest = p.cut(room)
                    pieces.insert(0, rest)
                out.append(p)
                room -= len(p.ids)
            yield out


_encoders: dict[str, Encoder] = {}


def pack_texts(docs: DataFrame, tokenizer: str, limits: Limits = Limits(), end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """docs(id, text[, prompt_tokens]) -> one row a piece. prompt_tokens: how many first tokens bear no loss (null or absent: none).

    with_ids adds the piece's token ids.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    arrow = [("doc_id", pa.int64())] + [(n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.list_(pa.int32()))] * with_ids

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, Encoder(tokenizer))
        packer, sequence = Packer(limits), TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def emit(sequences: Iterator[list[Piece]]) -> None:
            nonlocal sequence
            for pieces in sequences:
                offset = 0
                for p in pieces:
                    rows.append((p.doc, p.start, len(p.ids), zlib.crc32(p.ids.astype("<u4").tobytes()), p.total, sequence, offset) + ((p.ids,) if with_ids else ()))
                    offset += len(p.ids)
                sequence += 1

        def batch_of() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [[]] * len(arrow)
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, arrow, strict=True)], names=[n for n, _ in arrow])
            rows.clear()
            return out

        for batch in slices(batches, "text", CHUNK_BYTES):
            ids = batch.column("id").to_pylist()
            prompts = batch.column("prompt_tokens").to_pylist()
            for doc, own, prompt in zip(ids, encoder.encode(texts_of(batch.column("text")).to_pylist()), prompts, strict=True):
                emit(packer.add(doc, np.append(own, np.int32(end_id)), prompt or 0))
            yield batch_of()
        emit(packer.finish())
        yield batch_of()
        _encoders.clear()  # the process is reused for other work: it shall not hold what has been learned here

    prompt = F.col("prompt_tokens").cast("long") if "prompt_tokens" in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col("id").cast("long").alias("id"), "text", prompt.alias("prompt_tokens")).mapInArrow(released(pack), schema)


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    return pack_texts(docs, public_tokenizer())
