"""Jaccard join, fingerprints and sharding against brute force."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.llm import fingerprints, jaccard_join as J, sharding
from tests.llm.conftest import SCHEMA, VOCABULARY, prose


def shingles(text, n, lower=True):
    data = (text or "").encode()
    words = (data.lower() if lower else data).split()
    return frozenset(zip(*[words[k:] for k in range(n)])) if len(words) >= n else frozenset([tuple(words)] if words else [])


def brute_components(rows, n, percent):
    sets = [shingles(r[1], n) for r in rows]
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                top[max(x, y)] = min(x, y)
    least = defaultdict(list)
    for a, r in enumerate(rows):
        if r[0] is not None:
            least[root(a)].append(r[0])
    return Counter((r[0], len(s), min(least[root(a)], default=None) if s else r[0]) for a, (r, s) in enumerate(zip(rows, sets)))


def chain_rows(seed, families=12):
    """Families of texts around the thresholds, with chains of small edits,
    shared passages and short texts."""
    rng, rows = random.Random(seed), []
    passage = [rng.choice(VOCABULARY) for _ in range(30)]
    for f in range(families):
        words = [rng.choice(VOCABULARY) + str(rng.randint(0, 40)) for _ in range(rng.choice([1, 2, 3, 9, 12, 25, 60, 150, 400]))]
        for _ in range(rng.randint(1, 9)):
            if rng.random() < 0.3:
                words = words + passage[:rng.randint(1, 30)]
            rows.append(" ".join(w.upper() if rng.random() < 0.02 else w for w in words))
            words = [w if rng.random() > rng.choice([0.0, 0.005, 0.02, 0.05]) else rng.choice(VOCABULARY) for w in words]
            if len(words) > 4 and rng.random() < 0.3:
                words = words[rng.randint(0, 2):]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, t, None, None, *["x"] * 14) for i, t in zip(order, rows)]


@pytest.mark.parametrize("n,percent,seed", [(3, 90, 1), (5, 80, 2), (3, 50, 3)])
def test_components_match_all_pairs(spark, awkward, n, percent, seed):
    rows = awkward[1] + [(r[0] + 1000, *r[1:]) for r in chain_rows(seed)]
    out = J.link_components(spark.createDataFrame(rows, SCHEMA).repartition(3), n, percent).collect()
    assert Counter(tuple(r) for r in out) == brute_components(rows, n, percent)


def test_empty_and_single(spark, empty):
    assert J.link_components(empty).count() == 0 and J.keep_one(empty).count() == 0
    one = spark.createDataFrame([(7, "a b c d", None, None, *["x"] * 14)], SCHEMA)
    assert [tuple(r) for r in J.link_components(one).collect()] == [(7, 2, 7)]


def test_large_regions_are_divided(spark, monkeypatch):
    monkeypatch.setattr(J, "REGION_MEMBERS", 12)
    monkeypatch.setattr(J, "LEAF", 4)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(70):
        words = list(base)
        for _ in range(rng.randint(3, 12)):
            words[rng.randrange(200)] = f"v{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(words), None, None, *["x"] * 14))
    out = J.link_components(spark.createDataFrame(rows, SCHEMA), 3, 85).collect()
    assert Counter(tuple(r) for r in out) == brute_components(rows, 3, 85)


@given(st.integers(0, 10**6), st.integers(10, 120), st.floats(0, 0.3), st.sampled_from([50, 80, 90, 95]))
@settings(max_examples=300, deadline=None)
def test_linked_sets_share_a_region(seed, size, edit, percent):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64))
    keep = a[rng.random(len(a)) > edit]
    b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 62, int(size * edit * rng.random())).astype(np.uint64)]))
    shared = len(np.intersect1d(a, b))
    if len(b) and shared < max(len(a), len(b)) and J.linked(shared, len(a), len(b), percent):
        for s in (0, 1):
            (x, sure), (y, also) = J.region_keys(a, percent, s), J.region_keys(b, percent, s)
            assert len(np.intersect1d(x, y)) >= max(sure, also) >= 1


@given(st.integers(0, 10**6))
@settings(max_examples=25, deadline=None)
def test_region_links_reach_what_links_reach(seed):
    rng = np.random.default_rng(seed)
    base = [np.unique(rng.integers(0, 10**9, 80).astype(np.uint64)) for _ in range(6)]
    sets = []
    for _ in range(260):
        s = base[rng.integers(6)]
        sets.append(np.unique(np.concatenate([s[rng.random(len(s)) > 0.04], rng.integers(0, 10**9, 2).astype(np.uint64)])))
    groups = list(range(len(sets)))

    def closure(pairs):
        top = list(groups)

        def root(x):
            while top[x] != x:
                x = top[x]
            return x
        for a, b in pairs:
            a, b = root(a), root(b)
            top[max(a, b)] = min(a, b)
        return [root(x) for x in groups]

    every = [(a, b) for a in groups for b in range(a) if J.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]), 90)]
    assert closure(J.region_links(sets, groups, 90)) == closure(every)


def test_keep_one(spark, awkward):
    rows = awkward[1]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = J.keep_one(df, 3, 90)
    assert kept.columns == df.columns
    got = kept.collect()
    # Two components have the smallest id 5: that id has two texts.
    groups = Counter({c[2]: 1 for c in brute_components([r for r in rows if shingles(r[1], 3)], 3, 90)}) + Counter([5])
    assert Counter(r["doc_id"] for r in got if shingles(r["text"], 3)) == groups
    assert Counter((r["doc_id"], r["text"]) for r in got if not shingles(r["text"], 3)) == Counter(
        {(r[0], r[1]) for r in rows if not shingles(r[1], 3)})


def test_fingerprints(spark, awkward, empty):
    df, rows = awkward
    out = fingerprints.fingerprint_edits(df).collect()
    assert Counter((r.doc_id, r.n_chars) for r in out) == Counter((r[0], len(r[1] or "")) for r in rows)
    prints = {}
    for r in out:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[0] == prints[104] and prints[100] == prints[101] == prints[102] == {""}
    assert all(0.0 <= x <= 1.0 for r in out for x in (r.near_edited, r.near_next))
    assert fingerprints.fingerprint_edits(empty).count() == 0


@pytest.mark.parametrize("block", [200, 1 << 20])
def test_edits_take_the_next_text(spark, monkeypatch, block):
    monkeypatch.setattr(fingerprints, "BLOCK_BYTES", block)
    rng = random.Random(9)
    texts = {i: "é" * (i % 4) + prose(rng, rng.randint(0, 90)) for i in rng.sample(range(10**6), 60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    out = {r.doc_id: r for r in fingerprints.fingerprint_edits(df, k=4096).collect()}
    order = sorted(texts, reverse=True)
    for a, b in zip(order, order[1:] + order[:1]):
        t, cut = texts[a], len(texts[a]) // 3
        edited = t[:len(t) - cut] + texts[b][:cut]
        assert out[a].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other, near in ((edited, out[a].near_edited), (texts[b], out[a].near_next)):
            x, y = shingles(t, 5, False), shingles(other, 5, False)
            assert abs(near - (len(x & y) / len(x | y) if x | y else 1.0)) < 1e-9
    single = fingerprints.fingerprint_edits(df.limit(1)).collect()
    assert single[0].near_next == 1.0


def _hash_long(x, seed):
    return xxhash.xxh64_intdigest(struct.pack("<q", x), seed=seed)


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_sketch(text, k=128, n=5):
    """The k least distinct hashes of n-word shingles, by another library."""
    hashes = [_signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in re.findall("[^\x20\x09-\x0D]+", text)]

    def folded(values, seed):
        for v in values:
            seed = _hash_long(v, seed)
        return _signed(seed)
    if not hashes:
        return []
    if len(hashes) < n:
        return [folded(hashes, xxhash.xxh64_intdigest(struct.pack("<i", n), seed=42))]
    return sorted({folded(hashes[i:i + n], 42) for i in range(len(hashes) - n + 1)})[:k]


def _check_edits(rows, out, k=128):
    """``rows`` with distinct ids (one null), whole results."""
    texts = {i: t for i, t in rows}
    order = sorted(texts, key=lambda i: (i is not None, i or 0), reverse=True)
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    for a, b in zip(order, order[1:] + order[:1]):
        t, cut = texts[a], len(texts[a]) // 3
        edited, r = t[:len(t) - cut] + texts[b][:cut], got[a]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, changed, after = (brute_sketch(x, k) for x in (t, edited, texts[b]))
        text = lambda sketch: "".join(f"{x & (2**64 - 1):016x}" for x in sketch)
        assert r.fingerprint == text(own) and r.edited_fingerprint == text(changed)
        for other, near in ((changed, r.near_edited), (after, r.near_next)):
            union = sorted({*own, *other})[:k]
            assert abs(near - (len({*union} & {*own} & {*other}) / len(union) if union else 1.0)) < 1e-12


@pytest.mark.parametrize("block", [200, 1 << 20])
def test_large_and_negative_ids(spark, monkeypatch, block):
    monkeypatch.setattr(fingerprints, "BLOCK_BYTES", block)
    rng = random.Random(3)
    ids = [2**60 + k for k in range(30)] + [-2**60 - k for k in range(20)] + [2**63 - 1, -2**63, 0, -1, None]
    rows = [(i, prose(rng, rng.choice([0, 3, 40, 300]))) for i in ids]
    _check_edits(rows, fingerprints.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())


def test_many_rows_of_one_id(spark, monkeypatch):
    """Rows of one id, null here, are divided among blocks by their texts
    and still follow one another."""
    monkeypatch.setattr(fingerprints, "BLOCK_BYTES", 2_000)
    rng = random.Random(4)
    rows = [(k, f"text number {k}") for k in range(300)] + [(None, f"no id {rng.random()}") for k in range(4000)]
    rows += [(7, f"seven {k}") for k in range(2000)]
    out = fingerprints.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    tie = lambda t: _signed(xxhash.xxh64_intdigest(t.encode(), seed=42))
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), tie(r[1])))
    want = Counter()
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        cut = len(t) // 3
        want[i, hashlib.sha256((t[:len(t) - cut] + after[:cut]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in out) == want


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(2)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(6000)]
    a, b = words[:4000], words[2000:]
    df = spark.createDataFrame([(" ".join(a), " ".join(b), " ".join(a[:2004]), " ".join(a[2000:]))], "a string, b string, a1 string, a2 string")
    for c in df.columns:
        df = fingerprints.with_sketch(df, c, f"s_{c}", k=1024)
    s = lambda c: F.col(f"s_{c}")
    r = df.select(
        (fingerprints.merge(s("a1"), s("a2"), k=1024) == s("a")).alias("merged"),
        fingerprints.resemblance(s("a"), s("b"), 1024).alias("near"), fingerprints.containment(s("a"), s("b"), 1024).alias("inside"),
        fingerprints.distinct_shingles(s("a"), 1024).alias("n")).first()
    x, y = shingles(" ".join(a), 5), shingles(" ".join(b), 5)
    assert r.merged
    assert abs(r.near - len(x & y) / len(x | y)) < 0.07 and abs(r.inside - len(x & y) / len(x)) < 0.12 and abs(r.n / len(x) - 1) < 0.15


def _check_shards(out, rows, shards):
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    assert {r.law for r in out} <= {"bytes"} and {r.grown_shard for r in out} <= {None}


def test_shards(spark, awkward, empty):
    df, rows = awkward
    out = sharding.shard(df, 3).collect()
    _check_shards(out, rows, 3)
    assert sharding.shard(empty, 8).count() == 0


def test_shard_sizes_and_groups(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(5, 120)), None, None, *["x"] * 14) for i in range(1500)]
    rows += [(10_000 + i, "a copied text", None, None, *["x"] * 14) for i in range(300)]
    hot = prose(rng, 50)
    rows += [(20_000 + i, hot, None, None, *["x"] * 14) for i in range(1200)]
    out = sharding.shard(spark.createDataFrame(rows, SCHEMA).repartition(5), 8).collect()
    _check_shards(out, rows, 8)
    size = Counter()
    for r in out:
        size[r.shard] += r["size"]
    assert len(size) == 8 and max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 8
    text = {r[0]: r[1] for r in rows}
    at = defaultdict(set)
    for r in out:
        at[text[r.doc_id]].add(r.shard)
    assert len(at[hot]) > 1 and all(len(s) == 1 for t, s in at.items() if t != hot)
