"""Near-duplicate join on word n-grams with an exact Jaccard threshold.

1. One pass turns each text into its set of hashed shingles and keeps a small sketch: the size, a
   128-bit identity and the l-prefix. (Sets in hash order: of two sets that reach the threshold,
   each holds the first l common shingles among its first |A| - overlap + l.) Equal sets become one
   representative.
2. Prefix shingles are counted over all representatives. One that shares fewer than l of its prefix
   shingles cannot link and goes. For the others only the rarest c - l + 1 shared ones open tiles.
3. A tile is (size band, shingle): a set is at home in its band and a visitor in the next, as sets
   that link differ by less than one band. Of tiles with the same members one is kept. Within a
   tile pairs are pruned by size and by hashed bitmap signatures: the count of differing parity bits
   bounds the symmetric difference from below and so the overlap from above. What a tile gives is
   only a spanning forest of the pairs that pass, so never more rows than it has members.
4. The components of those forests are clusters: sets that link are in one cluster. The shingles
   of each set are made again and go once to its cluster, where pairs that pass the bound are settled by intersecting the
   sorted arrays. Here too a spanning forest of the links is given: pairs that are already in one
   component by other links are not compared.
5. Tiles and clusters of more than one block first compare each member with one leader. Blocks then pair
   the leader's group with the rest and the rest with itself, never the group with itself.

near_duplicates() gives components. near_duplicate_links() gives every link: there blocks pair all
members and skip nothing.

No candidate, partner, tile or cluster is capped. Components come from star rounds over written tables;
a written table is deleted as soon as nothing reads it.

Cases: a null or empty text has an empty set and links with nothing; null ids are dropped from
linking and reported with their own null component; rows repeated under an id are one document,
and an id with several texts is linked by each; an empty table gives an empty result; extra columns
are ignored. Words are hashed with a secret seed for each call, so that texts cannot be made to collide.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SALTS, WIDE_BITS, bitmap_of, components, counted_join, discard, lowered, materialize, maybe_in, mix, released, salted_left_join, sized, slices, sorted_unique, span_hashes, utf8, without, words_of

CHUNK_BYTES = 512 << 10
SIG_BITS = (512, 4096)  # of a signature: one or two a shingle, within these bounds
TILE_MEMBERS = 2048  # members of a tile that one block compares
CLUSTER_BYTES = 16 << 20  # of shingles that one block of a cluster holds
LOOSE = 20  # a leader takes sets into its candidate group at a threshold lower by so many percent


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int, seed: int = 0) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = lowered(data)
    starts, ends, first = words_of(data, at)
    w = span_hashes(data, starts, ends, seed)
    odd = [np.uint64(mix(np.array([k + 11], np.uint64))[0] | np.uint64(1)) for k in range(width + 1)]
    n = max(0, len(w) - width + 1)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h += w[k : k + n] * odd[k]
    h = mix(h)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(sorted_unique(h[a : b - width + 1]))
        elif b > a:
            out.append(mix((w[a:b] * np.array(odd[: b - a])).sum(dtype=np.uint64, keepdims=True) + np.array([b - a], np.uint64) * odd[width]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def least_overlap(n: int, percent: int) -> int:
    """Common shingles that a set of n needs with any set that it links with."""
    return -(-percent * n // 100)


def wanted(n: int) -> int:
    """l for a set of n: the more of its prefix must be shared, the fewer sets are looked at further."""
    return n // 20 + 1


def band_of(n: Column, percent: int) -> Column:
    return F.floor(F.log(n.cast("double")) / band_step(percent)).cast("int")


def band_step(percent: int) -> float:
    return float(np.log(100 / percent) * 1.0001)


def signature_bits(n: float) -> int:
    """Bits of a signature for sets of up to n: a power of two, so that a longer signature folds into a shorter one."""
    return min(max(SIG_BITS[0], 1 << int(np.ceil(np.log2(max(n, 2))))), SIG_BITS[1])


def signature(tokens: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the hashes that fall on each bit: each differing element turns one bit at most."""
    odd = np.bincount((tokens >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(sig: np.ndarray, words: int) -> np.ndarray:
    """A signature as it would be with fewer bits."""
    return np.bitwise_xor.reduce(sig.reshape(-1, words), axis=0)


def _sketch(width: int, percent: int, seed: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK_BYTES):
            sets = shingle_sets(*utf8(batch.column("text")), width, seed)
            prefix = [s[: min(len(s), len(s) - least_overlap(len(s), percent) + wanted(len(s)))] for s in sets]
            key = [(int(mix(s + np.uint64(7)).sum(dtype=np.uint64).view(np.int64)), int((mix(s) * (s | np.uint64(1))).sum(dtype=np.uint64).view(np.int64))) for s in sets]
            flat = np.concatenate(prefix) if prefix else np.zeros(0, np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, prefix)]), pa.int32()), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([k[0] for k in key], pa.int64()), pa.array([k[1] for k in key], pa.int64()), lists], names=["id", "n", "k1", "k2", "prefix"])

    return sketch


def _signatures(width: int, percent: int, seed: int):
    def bits(n: int) -> int:  # enough for the wider of the two bands that the set is in
        step = band_step(percent)
        return signature_bits(np.exp((np.floor(np.log(max(n, 1)) / step) + 2) * step))

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK_BYTES):
            got = shingle_sets(*utf8(batch.column("text")), width, seed)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in got], pa.int64()), pa.array([signature(s, bits(len(s))).tobytes() for s in got], pa.binary())], names=["id", "n", "sig"])

    return signatures


def _sets(width: int, seed: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK_BYTES):
            got = shingle_sets(*utf8(batch.column("text")), width, seed)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in got], pa.int64()), pa.array([s.tobytes() for s in got], pa.binary())], names=["id", "n", "tokens"])

    return sets


def bound_reaches(na, nb, bits, percent: int):
    """Whether sets of these sizes whose signatures differ in `bits` can still link: overlap <= (na + nb - bits) / 2."""
    most = (na + nb - bits) // 2
    return 100 * most >= percent * (na + nb - most)


def common(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted array with others."""
    flat = np.concatenate(others)
    hit = x[np.minimum(np.searchsorted(x, flat), len(x) - 1)] == flat
    return np.add.reduceat(hit, np.cumsum([0, *(len(o) for o in others[:-1])]), dtype=np.int64)


def links_with(x: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    both = common(x, others)
    return 100 * both >= percent * (len(x) + np.array([len(o) for o in others]) - both)


def runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of each key, of batches that are sorted by it."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(c).to_numpy() for c in keys])
        cut = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for x, y in zip(cut, cut[1:]):
            key = values[:, x].tolist()
            if rest and key != last:
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(batch.slice(x, y - x))
            last = key
    if rest:
        yield pa.Table.from_batches(rest)


def _ints(t: pa.Table, *names: str) -> list[np.ndarray]:
    return [t.column(c).to_numpy() for c in names]


def _forest(sig: np.ndarray, n: np.ndarray, comp: np.ndarray, percent: int, fits, settle, every: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js) of the pairs that link; members stand in order of size. Unless `every`, only pairs that join components (comp: what is known of them) are looked at and given.

    settle: the exact test of i with several j, or None.
    """
    label = np.unique(comp, return_inverse=True)[1]
    step = max(1, (1 << 19) // (len(n) * sig.shape[1]))  # rows whose signatures are compared at once
    for begin in range(0, len(n) - 1, step):
        rows, cols = np.arange(begin, min(begin + step, len(n) - 1)), np.arange(begin + 1, len(n))
        cols = cols[n[cols] <= 100 * n[rows[-1]] // percent]
        if not every:
            apart = label[rows][:, None] != label[cols]
            rows, cols = rows[apart.any(1)], cols[apart.any(0)]
        if not len(rows) or not len(cols):
            continue
        bits = np.bitwise_count(sig[rows][:, None] ^ sig[cols]).sum(2, dtype=np.int64)
        ok = (cols > rows[:, None]) & (100 * n[rows][:, None] >= percent * n[cols]) & bound_reaches(n[rows][:, None], n[cols], bits, percent) & fits(rows[:, None], cols)
        for r in np.flatnonzero(ok.any(1)).tolist():
            i, own = int(rows[r]), ok[r]
            j = cols[own][np.argsort(bits[r, own], kind="stable")]  # the likeliest first: they often settle the others of their component
            j = j if every else j[label[j] != label[i]]
            size = len(j) if every or settle is None else 8
            while len(j):
                now, j = j[:size], j[size:]
                now = now if settle is None else now[settle(i, now)]
                size *= 8
                if every:
                    if len(now):
                        yield i, now
                elif len(now):
                    parts, first = np.unique(label[now], return_index=True)
                    yield i, now[first]
                    for part in parts.tolist():
                        label[label == part] = label[i]
                    j = j[label[j] != label[i]]


def _pairs_of(ids: np.ndarray, found: Iterator[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    out = list(found)
    a = np.concatenate([np.full(len(j), ids[i]) for i, j in out]) if out else np.zeros(0, np.int64)
    b = np.concatenate([ids[j] for _, j in out]) if out else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _block_of(t: pa.Table):
    """Which pairs of a block are its own: their parts are the block's two."""
    (part,), lo, hi = _ints(t, "part"), t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
    return lambda i, j: (np.minimum(part[j], part[i]) == lo) & (np.maximum(part[j], part[i]) == hi)


def _near(percent: int):
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A spanning forest of the pairs of each block of a tile that pass the bounds."""
        for t in runs(batches, ("key", "lo", "hi")):
            t = t.sort_by("n")
            ids, n, comp = _ints(t, "id", "n", "comp")
            home, own = t.column("home").to_numpy(zero_copy_only=False), _block_of(t)
            sigs = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("sig")]
            words = min(map(len, sigs))
            sig = np.stack([folded(x, words) for x in sigs])
            yield _pairs_of(ids, _forest(sig, n, comp, percent, lambda i, j: (home[j] | home[i]) & own(i, j), None, False))

    return near


def _linked(percent: int, every: bool):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The links of each block of a cluster: a spanning forest of them, or every one."""
        for t in runs(batches, ("key", "lo", "hi")):
            t = t.sort_by("n")
            ids, n, comp = _ints(t, "id", "n", "comp")
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("tokens")]
            bits = signature_bits(2 * int(n.max()))
            sig = np.stack([signature(x, bits) for x in sets])
            yield _pairs_of(ids, _forest(sig, n, comp, percent, _block_of(t), lambda i, j: links_with(sets[i], [sets[k] for k in j.tolist()], percent), every))

    return linked


def _led_near(percent: int):
    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb = (batch.column(c).to_numpy() for c in ("a", "id", "na", "n"))
            keep = []
            for k, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sig"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                words = min(len(x), len(y))
                keep.append(bool(bound_reaches(na[k], nb[k], int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()), percent)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return led


def _led_linked(percent: int):
    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [bool(links_with(np.frombuffer(x.as_buffer(), np.uint64), [np.frombuffer(y.as_buffer(), np.uint64)], percent)[0]) for x, y in zip(batch.column("sa"), batch.column("tokens"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("id")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return led


def _compared(member: DataFrame, loads: DataFrame, load: str, weight: Column, limit: int, leader_check, block_check, every: bool = False) -> DataFrame:
    """member(key, id, n[, home]), loads(id, n, <load>) -> the pairs (a, b) that block_check gives, written, with those of leader_check.

    A key whose weights add up to more than `limit` takes several blocks. Rows of such keys are first
    compared with one leader; the blocks then leave out pairs within the leader's group. The loads
    travel once, to their blocks, and are not written with the members.
    """
    own = ["key", "id", "n", "weight", *[c for c in ("home",) if c in member.columns]]
    member = member.withColumn("weight", weight).select(own)
    sizes = materialize(member.groupBy("key").agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("k")).filter(F.col("total") > limit), "ngram-large")
    used, led = [sizes], None
    if not every and not sizes.isEmpty():
        some = salted_left_join(member, sized(sizes, SALTS).select("key", "k"), ["key"], F.xxhash64("id")).filter("k IS NOT NULL")
        one = some.groupBy("key").agg(F.min_by(F.struct("id", "n"), F.xxhash64("id", "key")).alias("l")).select("key", "l.id", "l.n")
        lead = materialize(one.join(loads.select("id", "n", load), ["id", "n"]).groupBy("key").agg(F.first("id").alias("a"), F.first("n").alias("na"), F.first(load).alias("sa")), "ngram-leaders")
        beside = salted_left_join(member.select("key", "id", "n"), sized(lead, SALTS, "sa"), ["key"], F.xxhash64("id")).filter("a <> id").join(loads.select("id", "n", load), ["id", "n"])
        led = materialize(beside.select("a", "id", "na", "n", "sa", load).mapInArrow(released(leader_check), "a long, b long"), "ngram-led")
        group = materialize(led.select(F.col("a"), F.col("b").alias("id")).distinct(), "ngram-group")
        keyed = salted_left_join(member, sized(lead, SALTS).select("key", "a"), ["key"], F.xxhash64("id"))
        main = F.coalesce("in", F.col("id") == F.col("a"), F.lit(False))
        split = keyed.join(sized(group).withColumn("in", F.lit(True)), ["a", "id"], "left").select(*own, main.alias("main"), F.when(main, F.col("a")).otherwise(F.col("id")).alias("comp"))
        member = materialize(split, "ngram-split")
        used += [lead, led, group, member]
    else:
        member = member.withColumns({"main": F.lit(False), "comp": F.col("id")})
    parts = lambda w: F.ceil(F.coalesce(F.sum(w), F.lit(0)) / limit).cast("int")
    per = member.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.min("comp").alias("c"), F.max("comp").alias("d"), parts(F.when(F.col("main"), F.col("weight"))).alias("gp"), parts(F.when(~F.col("main"), F.col("weight"))).alias("rp"))
    per = materialize(per.filter("c <> d" if not every else "k > 1").select("key", "gp", F.greatest("rp", F.lit(1)).alias("rp")), "ngram-blocks")
    some = salted_left_join(member, sized(per, SALTS), ["key"], F.xxhash64("id")).filter("rp IS NOT NULL")
    spot = lambda p: F.pmod(F.xxhash64("id", F.lit(7)), F.greatest(p, F.lit(1))).cast("int")
    some = some.withColumn("part", F.when(F.col("main"), spot(F.col("gp"))).otherwise(F.col("gp") + spot(F.col("rp"))))
    # the parts of the leader's group come first and do not meet one another
    dealt = some.withColumn("other", F.explode(F.sequence(F.when(F.col("main"), F.col("gp")).otherwise(0), F.col("gp") + F.col("rp") - 1)))
    dealt = dealt.select(*[c for c in own if c != "weight"], "comp", "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
    loaded = dealt.join(loads.select("id", "n", load), ["id", "n"])
    sorted_ = loaded.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    out = sorted_.mapInArrow(released(block_check), "a long, b long")
    out = materialize((out if led is None else out.unionByName(led)).filter("a <> b").distinct(), "ngram-pairs")
    discard(per, *used)
    return out


def _clusters(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, tile_members: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """sketch, followers (id, rep) of one text and of several, clusters (id, key) and the sets of their members."""
    seed = secrets.randbits(63)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sketch = materialize(rows.mapInArrow(released(_sketch(width, percent, seed)), "id long, n long, k1 long, k2 long, prefix array<long>"), "ngram-sketch")
    real = sketch.filter("n > 0 AND id IS NOT NULL")

    # copies of one set stand behind their lowest id
    groups = real.groupBy("n", "k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    same = materialize(groups.filter("copies > 1").drop("copies"), "ngram-same")
    behind = salted_left_join(sketch.select("id", "n", "k1", "k2"), sized(same, SALTS), ["n", "k1", "k2"], F.xxhash64("id")).filter("id <> rep").select("id", "rep").distinct()
    behind = materialize(behind, "ngram-behind")

    # shared prefix shingles; followers are left out, but an id with several texts keeps all of them
    maybe = maybe_in(sketch.select("id", "n", "k1", "k2").distinct(), F.xxhash64("id"), bitmap_of(behind, F.xxhash64("id")))
    gone = maybe.join(sized(behind).select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("texts")).filter("texts = 1").select("id")
    gone = materialize(gone, "ngram-gone")
    alone = sized(gone)
    followers, several = behind.join(alone, "id", "left_semi"), behind.join(alone, "id", "left_anti")
    posts = without(real.select("id", "n", "prefix"), gone, "id", WIDE_BITS).select("id", "n", F.explode("prefix").alias("token"))
    df = materialize(posts.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "ngram-df")
    total = df.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    # most shingles occur once: the bitmap keeps their postings out of the shuffle
    again = maybe_in(posts, F.col("token"), bitmap_of(df, F.col("token"), WIDE_BITS), WIDE_BITS)
    shared = counted_join(again, df, "token", "df", total, F.xxhash64("id")).groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("shared"))
    need = F.expr(f"(({percent} * n + 99) div 100) div 20 + 1")
    lasting = shared.withColumn("need", need).filter("size(shared) >= need")
    tiles = lasting.select("id", "n", F.explode(F.expr("slice(shared, 1, cast(size(shared) - need + 1 as int))")).alias("s")).select("id", "n", F.col("s.token").alias("token"))
    band = band_of(F.col("n"), percent)
    tiles = tiles.select("id", "n", F.explode(F.array(F.struct(band.alias("band"), F.lit(True).alias("home")), F.struct((band + 1).alias("band"), F.lit(False).alias("home")))).alias("b"), "token")
    tiles = materialize(tiles.select(F.xxhash64("b.band", "token").alias("key"), "id", "n", "b.home"), "ngram-posts")
    discard(df, same)
    # of tiles with the same members one is enough; one member, or visitors only, make no pair
    who = tiles.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.sum(F.xxhash64("id", "n", "home").cast("decimal(38,0)")).alias("who"), F.max("home").alias("any_home")).filter("k > 1 AND any_home")
    who = materialize(who.groupBy("k", "who").agg(F.min("key").alias("key")), "ngram-who")
    size = who.agg(F.coalesce(F.sum("k"), F.lit(0))).first()[0]
    own = maybe_in(tiles, F.col("key"), bitmap_of(who, F.col("key"), WIDE_BITS), WIDE_BITS)
    member = materialize(counted_join(own, who.select("key", "k"), "key", "k", size, F.xxhash64("id")).drop("k"), "ngram-members")
    discard(tiles, who)

    # signatures of what is left, then the sets of what its tiles have put together
    def texts_in(ids: DataFrame) -> DataFrame:
        return maybe_in(rows, F.xxhash64("id"), bitmap_of(ids, F.xxhash64("id"), WIDE_BITS), WIDE_BITS)

    sigs = materialize(texts_in(member).mapInArrow(released(_signatures(width, percent, seed)), "id long, n long, sig binary"), "ngram-signatures")
    near = _compared(member, sigs, "sig", F.lit(1), tile_members, _led_near(percent - LOOSE), _near(percent))
    discard(member, sigs)
    cluster = materialize(components(near, "ngram").select(F.col("node").alias("id"), F.col("component").alias("key")), "ngram-clusters")
    discard(near)
    sets = materialize(texts_in(cluster).mapInArrow(released(_sets(width, seed)), "id long, n long, tokens binary"), "ngram-sets")
    return sketch, followers, several, cluster, sets


def _links(cluster: DataFrame, sets: DataFrame, percent: int, cluster_bytes: int, every: bool = False) -> DataFrame:
    member = sized(cluster).join(sets.select("id", "n"), "id").filter("n > 0")
    out = _compared(member, sets, "tokens", F.greatest(8 * F.col("n"), F.lit(4096)), cluster_bytes, _led_linked(percent), _linked(percent, every), every)
    discard(sets, cluster)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85, tile_members: int = TILE_MEMBERS, cluster_bytes: int = CLUSTER_BYTES) -> DataFrame:
    """One row a document: id, n_shingles and component_id, the smallest id reachable over links of Jaccard similarity >= percent / 100."""
    sketch, followers, several, cluster, sets = _clusters(docs, id_col, text_col, width, percent, tile_members)
    links = _links(cluster, sets, percent, cluster_bytes)
    # an id of several texts ties what they link with; the copies of a set hang on its representative and come after
    comp = materialize(components(links.unionByName(several.select(F.col("rep").alias("a"), F.col("id").alias("b"))), "ngram-all"), "ngram-comp")
    of_rep = followers.select("rep").distinct().join(comp.withColumnRenamed("node", "rep").hint("merge"), "rep").select("rep", "component")
    hang = salted_left_join(followers, of_rep, ["rep"], F.xxhash64("id")).select("id", F.coalesce("component", "rep").alias("component"))
    final = materialize(comp.select(F.col("node").alias("id"), "component").unionByName(hang), "ngram-final")
    discard(links, comp)
    out = sketch.select("id", "n").join(sized(final), "id", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def near_duplicate_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85, tile_members: int = TILE_MEMBERS, cluster_bytes: int = CLUSTER_BYTES) -> tuple[DataFrame, DataFrame]:
    """(pairs, members). pairs(a, b), a < b: all representatives that link, in one component or not. members(id, rep): the representative of each id's set, one row a set.

    Ids stand for the same representative if their sets are equal; they link with all that it links
    with and with one another. An id with several texts is also paired by each of them. Quadratic in the size of a group of near copies, as the links are.
    """
    sketch, _, _, cluster, sets = _clusters(docs, id_col, text_col, width, percent, tile_members)
    pairs = _links(cluster, sets, percent, cluster_bytes, every=True)
    real = sketch.filter("n > 0 AND id IS NOT NULL").select("id", "n", "k1", "k2")
    reps = materialize(real.groupBy("n", "k1", "k2").agg(F.min("id").alias("rep")), "ngram-reps")
    members = salted_left_join(real, sized(reps, SALTS), ["n", "k1", "k2"], F.xxhash64("id")).select("id", "rep").distinct()
    return pairs, members


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), width=4, percent=85)
