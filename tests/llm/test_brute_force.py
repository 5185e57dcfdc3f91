"""The url tree, the shuffle and the whole pipeline against plain versions of their own."""

import math
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline as cp
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemill.llm import packing, quality_crf, sharding, url_filters

from .test_operators import brute_components

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- op1
def plain_templates(pages, s):
    """pages: (host, segments, bad or None) -> {(host, segments): (template, purity)}, node by node."""
    found = defaultdict(list)

    def walk(host, tmpl, rows):
        found[host, tmpl] += [(whole, bad) for whole, left, bad in rows if not left]
        rows = [r for r in rows if r[1]]
        if not rows:
            return
        if len(rows) < s.min_support:
            for whole, left, bad in rows:
                found[host, tmpl + "/*" * len(left)].append((whole, bad))
            return
        same = 0
        while all(len(left) > same for _, left, _ in rows) and len({left[same] for _, left, _ in rows}) == 1:
            same += 1
        if same:
            tmpl += "".join("/" + x for x in rows[0][1][:same])
            found[host, tmpl] += [(whole, bad) for whole, left, bad in rows if len(left) == same]
            rows = [(whole, left[same:], bad) for whole, left, bad in rows if len(left) > same]
        child = defaultdict(list)
        for whole, left, bad in rows:
            child[left[0]].append((whole, left[1:], bad))
        kinds = defaultdict(list)  # (usual rest) -> [(rate, labelled, bad, segment)]
        for seg, own in child.items():
            if len(own) >= s.min_support:
                rest = max((n, r) for r, n in Counter("/".join(left) for _, left, _ in own).items())[1]
                lab, bad = sum(b is not None for *_, b in own), sum(b or 0 for *_, b in own)
                kinds[rest].append(((bad + 0.5) / (lab + 1), lab, bad, seg))
        label = {}
        for group in kinds.values():
            clusters = []  # [labelled, bad, segments]
            for rate, lab, bad in sorted({x[:3] for x in group}):
                segs = [x[3] for x in group if x[:3] == (rate, lab, bad)]
                differs = True
                if clusters:
                    clab, cbad, _ = clusters[-1]
                    p = (cbad + bad + 0.5) / (clab + lab + 1)
                    differs = abs((cbad + 0.5) / (clab + 1) - rate) > s.merge_z * math.sqrt(p * (1 - p) * (1 / (clab + 1) + 1 / (lab + 1)))
                if differs:
                    clusters.append([0, 0, []])
                clusters[-1][0] += lab * len(segs)
                clusters[-1][1] += bad * len(segs)
                clusters[-1][2] += segs
            for *_, segs in clusters:
                segs.sort()
                name = segs[0] if len(segs) == 1 else f"{segs[0]}|{segs[-1]}" + (f"|+{len(segs) - 2}" if len(segs) > 2 else "")
                label |= dict.fromkeys(segs, "*" if "*" in segs else name)
        below = defaultdict(list)
        for seg, own in child.items():
            below[label.get(seg, "*")] += own
        for name, own in below.items():
            walk(host, f"{tmpl}/{name}", own)

    for host in {h for h, _, _ in pages}:
        walk(host, "", [(segs, list(segs), bad) for h, segs, bad in pages if h == host])
    known = lambda rows: (sum(b is not None for _, b in rows), sum(b or 0 for _, b in rows))
    lab, bad = known([r for rows in found.values() for r in rows])
    overall = (bad + 0.5) / (lab + 1.0) if lab else 0.0
    out = {}
    for (host, tmpl), rows in found.items():
        hlab, hbad = known([r for (h, _), rs in found.items() if h == host for r in rs])
        rate = (hbad + s.prior_weight * overall) / (hlab + s.prior_weight)
        tlab, tbad = known(rows)
        out |= {(host, whole): (tmpl, (tbad + s.prior_weight * rate) / (tlab + s.prior_weight)) for whole, _ in rows}
    return out


@pytest.mark.parametrize("seed, support", [(1, 5), (2, 20)])
def test_url_tree_equals_a_plain_one(spark, seed, support):
    r = random.Random(seed)
    words = ["news", "spam", "blog", "shop", "en", "de", "a", "b", "*", "a|b"]
    rows = [(0, None, 1), (1, "no scheme", 0), (2, "http://bare.org", None), (2, "http://bare.org", None)]
    for i in range(3, 1500):
        host = r.choice(["h.com", "h.com", "H.com", "k.net", f"rare{r.randint(0, 9)}.org"])
        path = ["top"] * (host == "k.net") + [r.choice(words[: r.randint(1, len(words))]) for _ in range(r.randint(0, 4))]
        bad = r.choice([None, int(r.random() < (0.9 if "spam" in path else 0.4 if "shop" in path else 0.05))])
        rows.append((i, f"http://{host}/" + "/".join(path) + r.choice(["", "/", f"/{i}", f"/{i}.html", "?q=1"]), bad))
    df = spark.createDataFrame(rows, "page_id long, url string, bad int")
    settings = url_filters.TemplateSettings(min_support=support)
    labels = df.filter("bad IS NOT NULL").select("page_id", "bad")
    got = url_filters.judge_urls(df, [], labels, settings).collect()
    bad_of = {i: b for i, _, b in rows}

    def shape(url):
        host, path = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "").groups() if "://" in (url or "") else ("", "")
        return host.lower(), tuple(re.sub("[0-9]+", "<n>", x) for x in path.split("/") if x)

    want = plain_templates([(*shape(url), bad_of[i]) for i, url, _ in rows], settings)
    assert len(got) == len(rows)
    urls = {i: url for i, url, _ in rows}
    for x in got:
        tmpl, purity = want[shape(urls[x.page_id])]
        assert (x.template, x.verdict) == (tmpl, "block" if purity >= settings.block_at else "allow") and abs(x.purity - purity) < 1e-9, x
    assert len({x.template for x in got}) > 10 and {x.verdict for x in got} == {"allow", "block"}


# ---------------------------------------------------------------- op10
def fisher_yates(n, seed):
    """The order in which n items come out of an inside-out Fisher-Yates shuffle by a Mersenne twister of a 64-bit seed."""
    raw = np.random.RandomState(np.array([seed >> 32 & 0xFFFFFFFF, seed & 0xFFFFFFFF], np.uint32))._bit_generator.random_raw
    order = [0] * n
    for i in range(n):
        bound = i + 1
        if bound & -bound == bound:
            j = bound * (int(raw()) >> 1) >> 31
        else:
            while True:
                bits = int(raw()) >> 1
                j = bits % bound
                if bits - j + bound - 1 < 1 << 31:
                    break
        order[i] = order[j]
        order[j] = i
    return order


def test_shuffle_equals_a_plain_one(spark, tmp_path):
    texts = [(i % 700, [None, "", "x" * (i % 90), "same"][i % 4]) for i in range(1500)]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/in")
    frame = spark.read.parquet(f"{tmp_path}/in")
    size = sum(len(t or "") + 64 for _, t in texts)
    got = sharding.assign_shards(frame, 7, bucket_bytes=20_000, seed=11).collect()
    buckets = -(-size // 20_000)
    dealt = defaultdict(list)
    for place in range(len(texts)):
        h = xxhash.xxh64_intdigest(place.to_bytes(8, "little"), seed=42)
        h = xxhash.xxh64_intdigest((11).to_bytes(4, "little"), seed=h)
        dealt[(h - (1 << 64) if h >> 63 else h) % buckets].append(place)
    assert buckets > 3 and len(dealt) == buckets
    order = [dealt[b][k] for b in range(buckets) for k in fisher_yates(len(dealt[b]), 11 + b)]
    n = len(order)
    shard = [rank * 7 // n for rank in range(n)]
    want = [(shard[rank], rank - shard.index(shard[rank]), *texts[place]) for rank, place in enumerate(order)]
    assert sorted(((x.shard, x.slot, x.doc_id, x.text) for x in got), key=lambda x: x[:2]) == want


# ---------------------------------------------------------------- the pipeline
def plain_odds(model, text):
    """Log-odds of the length-weighted share of good lines, by a plain forward-backward pass of one document."""
    data = np.frombuffer(text.encode(), np.uint8)
    bins, size, first = quality_crf.line_features(data, np.array([0, len(data)]))
    emit = [float(sum(model.weights[k] for k in row)) for row in quality_crf.with_neighbours(bins, first)]
    tie = {(1, 1): model.stay[0], (0, 0): model.stay[1], (0, 1): 0.0, (1, 0): 0.0}

    def add(a, b):
        return max(a, b) + math.log1p(math.exp(-abs(a - b)))

    fwd = [(0.0, emit[0])]
    for e in emit[1:]:
        bad, good = fwd[-1]
        fwd.append((add(bad + tie[0, 0], good + tie[1, 0]), e + add(bad + tie[0, 1], good + tie[1, 1])))
    back = [(0.0, 0.0)]
    for e in reversed(emit[1:]):
        bad, good = back[-1][0], back[-1][1] + e
        back.append((add(tie[0, 0] + bad, tie[0, 1] + good), add(tie[1, 0] + bad, tie[1, 1] + good)))
    good = [1 / (1 + math.exp(min(500, f[0] + b[0] - f[1] - b[1]))) for f, b in zip(fwd, reversed(back), strict=True)]
    share = sum(g * (n + 1) for g, n in zip(good, size.tolist(), strict=True)) / sum(n + 1 for n in size.tolist())
    share = min(max(share, 1e-4), 1 - 1e-4)
    return math.log(share / (1 - share))


def holds(text, item):
    """Whether at least 0.6 of the five-word shingles of the item's question and of its answer are in the text."""
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())
    lines = [x for x in item.split("\n") if x.strip()]
    parts = ["\n".join(lines[:-1]), lines[-1]] if len(lines) > 1 else [x for x in re.split(r"(?<=[.!?])\s+", item.strip()) if x]
    parts = [" ".join(parts[:-1]), parts[-1]] if len(parts) > 1 else [item]
    said = words(text)
    for own in map(words, parts):
        w = min(5, len(own))
        held = {tuple(said[k : k + w]) for k in range(len(said) - w + 1)}
        wanted = [tuple(own[k : k + w]) for k in range(len(own) - w + 1)] if w else []
        if wanted and sum(x in held for x in wanted) < 0.6 * len(wanted):
            return False
    return True


def test_run_equals_plain_stages(spark, tmp_path):
    """Texts of the fixture, with copies, near copies and benchmark passages planted among them."""
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    base, items = read("documents").orderBy("doc_id"), [r.text for r in read("benchmark").orderBy("item_id").collect()]
    fields = base.columns
    rows = [r.asDict() for r in base.collect()]
    r, new = random.Random(5), 1 + max(x["doc_id"] for x in rows)
    long = [x for x in rows if x["text"] and len(x["text"].split(" ")) > 120][:24]
    for k, x in enumerate(long):
        words = x["text"].split(" ")
        if k % 3 == 1:
            words[r.randrange(len(words))] = "altered"
        elif k % 3 == 2:  # else an exact copy
            at = len(words) // 2
            words = [f"own{k}", *words[:at], items[k % len(items)], *words[at:], *[f"tail{k}{j}" for j in range(len(words))]]
        rows.append(x | {"doc_id": new + k, "text": " ".join(words)})
    rows += [x | {"doc_id": new + 100 + k, "text": t} for k, (x, t) in enumerate(zip(rows, [None, "", "a few words", "a few words"]))]
    spark.createDataFrame([tuple(x[f] for f in fields) for x in rows], base.schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        read(name).write.parquet(f"{tmp_path}/{name}.parquet")
    got = cp.run(spark, str(tmp_path)).collect()

    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    model = quality_crf.fit_quality_model(spark.read.parquet(f"{tmp_path}/documents.parquet"), quality_crf.learnable(labels))
    score = lambda t: 1 / (1 + math.exp(-(model.slope * plain_odds(model, t or "") + model.shift)))
    kept = {x["doc_id"]: x["text"] or "" for x in rows if score(x["text"]) >= quality_crf.REJECT_BELOW}
    steps = [len(rows), len(kept)]
    last = {t: d for d, t in sorted(kept.items())}
    kept = {d: t for t, d in last.items()}
    steps.append(len(kept))
    group = brute_components(list(kept.items()), 5, 80)
    kept = {d: t for d, t in kept.items() if group[d][1] == d}
    steps.append(len(kept))
    kept = {d: t for d, t in kept.items() if not any(holds(t, x) for x in items)}
    steps.append(len(kept))
    assert all(a > b for a, b in zip(steps, steps[1:])), steps  # every stage had something to do

    from tokenizers import Tokenizer

    library, ids, slots = Tokenizer.from_file(packing.public_tokenizer()), defaultdict(list), defaultdict(list)
    for x in got:
        ids[x.doc_id].append((x.start, list(x.ids)))
        slots[x.sequence_id].append((x.offset, x.length))
    assert ids.keys() == kept.keys()
    for d, pieces in ids.items():
        pieces.sort()
        assert [k for _, p in pieces for k in p] == [*library.encode(kept[d], add_special_tokens=False).ids, 1], d
    for pieces in slots.values():
        pieces.sort()
        end = 0
        for offset, length in pieces:
            assert offset == end
            end += length
        assert end == 2048 or (end < 2048 and end & -end == end)
