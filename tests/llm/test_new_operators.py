"""Source divergence, WARC archives and centroid clusters against brute force."""

import base64
import gzip
import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from cohortlens.llm import centroid_search, source_divergence, warc
from cohortlens.llm.term_transducer import Transducer, build

_TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------ transducer

def _spans(terms):
    length = np.array([len(t) for t in terms], dtype=np.int64)
    return np.frombuffer(b"".join(terms), dtype=np.uint8), np.cumsum(length) - length, length


def test_transducer_ranks_its_terms_and_no_other():
    rng = random.Random(2)
    for letters in (b"ab", bytes(range(97, 123)), bytes(range(128, 256))):
        terms = sorted({bytes(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(400)})
        others = [t + b"a" for t in terms] + [t[:-1] for t in terms if len(t) > 1]
        walk = Transducer([build(terms)], [5])
        rank = {t: k + 5 for k, t in enumerate(terms)}
        got = walk.ordinals(*_spans(terms + others), np.zeros(len(terms + others), dtype=np.int64))
        assert got.tolist() == [rank.get(t, -1) for t in terms + others]


def test_transducer_is_minimal():
    """States are the distinct sets of continuations."""
    rng = random.Random(3)
    terms = sorted({bytes(rng.choices(b"abc", k=rng.randint(1, 6))) for _ in range(150)})
    after = defaultdict(set)
    for t in terms:
        for k in range(len(t) + 1):
            after[t[:k]].add(t[k:])
    assert len(build(terms)["final"]) == len({frozenset(s) for s in after.values()})


def test_transducer_of_nothing_and_bad_orders():
    walk = Transducer([build([])], [0])
    assert walk.ordinals(*_spans([b"a"]), np.zeros(1, dtype=np.int64)).tolist() == [-1]
    assert Transducer([], []).ordinals(*_spans([b"a"]), np.full(1, -1)).tolist() == [-1]
    for bad in ([b"b", b"a"], [b"a", b"a"], [b""]):
        with pytest.raises(ValueError):
            build(bad)


# ------------------------------------------------------ source divergence

def _brute_audit(rows, least=10, top=10):
    rows = [(lang or "", source or "", _TERM.findall((text or "").translate(_LOWER))) for text, lang, source in rows]
    df = Counter((lang, t) for lang, _, ts in rows for t in set(ts))
    kept = defaultdict(list)
    for (lang, t), n in df.items():
        if n >= least:
            kept[lang].append(t)
    counts = defaultdict(Counter)
    for lang, source, ts in rows:
        counts[lang, source].update(t for t in ts if df[lang, t] >= least)
    out = []
    for lang, source in counts:
        terms = kept[lang]
        p = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(terms)) for t in terms}  # noqa: B023, E731
        f = lambda a, b: (a - b) ** 2 // (a + b)
        own = p(counts[lang, source])
        pairs = [(o, sum(f(own[t], q) for t, q in p(counts[lang, o]).items())) for x, o in counts if x == lang and o != source]
        whole = sum((c for (x, _), c in counts.items() if x == lang), Counter())
        best = [(t, f(own[t], q)) for t, q in p(whole).items() if counts[lang, source][t] and own[t] > q]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", best, top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, v, k + 1) for k, (item, v) in enumerate(items[:most])]
    return sorted(out)


def _audited(df, **kw):
    return sorted(map(tuple, source_divergence.audit(df, **kw).collect()))


def _documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, ordinal int")


def _words(rng, n, letters="abcdeé中Z"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    rows = [(_words(rng, rng.randint(0, 60)), rng.choice(["en", "en", "fr", None, ""]), rng.choice(["a", "b", "é", "z z", None]))
            for _ in range(300)]
    rows += [(None, None, None), ("", "en", "only empty"), ("@[`{ 123 \x7f", "en", "no terms"), ("lone", "xx", "s"), ("one", "yy", "s"), ("two", "yy", "t"),
             (_words(rng, 60_000), "en", "long"), ("q" * 300_000 + " end", "en", "long")]
    rows += [("same text again", "de", "copies")] * 40 + [("Same TEXT, other", "de", "others")] * 5
    return rows


def test_audit_against_brute_force(spark, texts):
    assert _audited(_documents(spark, texts).repartition(5)) == _brute_audit(texts)


def test_audit_in_many_blocks_and_broadcasts(spark, texts, monkeypatch):
    monkeypatch.setattr(source_divergence, "BLOCK_BYTES", 150)
    assert _audited(_documents(spark, texts).repartition(3), least=4, top=3, broadcast_bytes=6_000) == _brute_audit(texts, 4, 3)


def test_audit_of_more_sources_than_a_tile(spark):
    rng = random.Random(8)
    rows = [(_words(rng, 6, "ab"), "en", f"s{k % 270}") for k in range(400)]
    assert _audited(_documents(spark, rows)) == _brute_audit(rows)


def test_audit_of_an_empty_table(spark):
    df = source_divergence.audit(_documents(spark, [("a", "b", "c")]).filter("false"))
    assert df.collect() == [] and df.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_counts_beyond_64_bits_stay_exact():
    n = np.array([0, 10**13, 5 * 10**17])
    assert source_divergence.shares(n, 6 * 10**17, 10**6).tolist() == [1 + 10**9 * (x + 2) // (6 * 10**17 + 2 * 10**6) for x in n.tolist()]


# ------------------------------------------------------------------ WARC

_PAGE = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                      T.StructField("offset", T.StringType()), T.StructField("head", T.StringType())])


def _pages():
    rng = random.Random(4)
    rows = [(k, f"http://h/{k}", "<p>" + "".join(rng.choices("ab é\r\n", k=rng.randint(0, 300)))) for k in range(60)]
    rows += [(100 + k, f"http://c/{k % 3}", "copied\r\n\r\npage") for k in range(40)]
    rows += [(200, "http://x/ \r\nWARC-Type: fake", "again"), (200, "http://x/ \r\nWARC-Type: fake", "again"), (200, "http://a", "again"),
             (2**60 + 1, None, "big id"), (2**60 + 3, "u", "big id"), (2**60 + 3, None, "big id"), (None, "u", "big id"), (None, None, None), (None, None, ""),
             (-5, "", ""), (-5, "", ""), (7, "http://h/7", "z" * 3_000_000), (8, "u", "only null id"), (None, "n", "null id"), (None, "n", "null id")]
    return [(*r, "x", "y") for r in rows]


def _brute_pages(rows, at_least=0):
    out, by = [], defaultdict(list)
    for page_id, _url, html, *_ in rows:
        by[(html or "").encode()].append(page_id)
    for data, ids in by.items():
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        ids.sort(key=lambda x: (x is not None, x or 0), reverse=True)
        out += [(i, len(data), digest, "response" if k == 0 or len(data) < at_least else "revisit",
                 None if k == 0 or len(data) < at_least else ids[0]) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


_RESULT = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("at_least", [0, 7])
def test_round_trip_against_brute_force(spark, at_least):
    rows = _pages()
    got = warc.round_trip(spark.createDataFrame(rows, _PAGE).repartition(4), at_least).select(*_RESULT).collect()
    assert sorted(map(tuple, got), key=repr) == _brute_pages(rows, at_least)


def _members(data):
    """All records of an archive, read from end to end."""
    data, out = gzip.decompress(data), []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        assert lines[0] == "WARC/1.1" and rest[n:n + 4] == b"\r\n\r\n"
        out.append((fields, rest[:n]))
        data = rest[n + 4:]
    return out


def test_archives_hold_every_record_and_only_the_index_counts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ROLL_BYTES", 2_000)
    rows, folder = _pages(), str(tmp_path / "archives")
    index = warc.write_archives(spark.createDataFrame(rows, _PAGE).repartition(2), folder)
    entries = index.collect()
    names = {r["archive"] for r in entries}
    (tmp_path / "archives" / "000000-lost.warc.gz").write_bytes(b"left by a lost attempt")
    records = {}
    for name in names:
        members = _members((tmp_path / "archives" / name).read_bytes())
        assert members[0][0]["WARC-Type"] == "warcinfo"
        for fields, block in members[1:]:
            assert fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
            records[fields["WARC-Record-ID"]] = fields
    assert len(records) == len(rows) == len(entries)
    for fields in records.values():
        if fields["WARC-Type"] == "revisit":
            target = records[fields["WARC-Refers-To"]]
            assert target["WARC-Type"] == "response" and target["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"]
    some = index.filter("url like 'http://h/%' and page_id % 7 = 0")
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_records(some, folder).collect() if len(r["payload"]) < 10_000}
    assert got == {p: h for p, u, h, *_ in rows if p is not None and u and u.startswith("http://h/") and p % 7 == 0 and len(h) < 10_000}
    assert warc.read_records(index.filter("false"), folder).collect() == []


def test_a_spoiled_payload_is_an_error(spark, tmp_path):
    page = {"page_id": 1, "url": "u", "referred": False, "record_type": "response", "payload_bytes": 4, "sha1": hashlib.sha1(b"text").hexdigest(),
            "payload": b"text", "refers_to": None, "refers_url": None}
    record = warc.page_record(page, "2024-01-01T00:00:00Z")
    assert warc.parse_page(record)["payload"] == b"text"
    with pytest.raises(ValueError):
        warc.parse_page(record.replace(b"text\r\n", b"tent\r\n"))
    with pytest.raises(ValueError):
        warc.parse_page(record[:-1])


def test_ranges_join_near_records_only():
    row = lambda a, o, n: {"archive": a, "offset": o, "length": n}
    rows = [row("a", 0, 10), row("a", 10, 10), row("a", 25, 10), row("a", 100, 10), row("b", 110, 500), row("b", 610, 1)]
    assert [len(r) for r in warc.ranges(rows, gap=5, most=50)] == [3, 1, 1, 1]


def test_an_empty_table_of_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], _PAGE)).collect() == []


def test_no_file_is_read_whole(spark, tmp_path):
    """Reading one record touches only its bytes of the archive."""
    rows = [(k, f"u{k}", os.urandom(40_000).hex(), None, None) for k in range(8)]
    folder = str(tmp_path / "a")
    index = warc.write_archives(spark.createDataFrame(rows, _PAGE).coalesce(1), folder)
    entries = sorted(index.collect(), key=lambda r: r["offset"])
    one = entries[4]
    path = tmp_path / "a" / one["archive"]
    data = bytearray(path.read_bytes())
    data[:one["offset"]] = bytes(one["offset"])
    data[one["offset"] + one["length"]:] = b""
    path.write_bytes(bytes(data))
    got = warc.read_records(index.filter(f"page_id = {one['page_id']}"), folder).collect()
    assert [bytes(r["payload"]).decode() for r in got] == [rows[one["page_id"]][2]]


# -------------------------------------------------------------- centroids

def _brute_nearest(X, C):
    D = ((X[:, None, :] - C[None]) ** 2).sum(axis=2)
    return D.argmin(axis=1), D.min(axis=1)


@pytest.mark.parametrize("spread", [1, 3, 1000, 1 << 26])
def test_scan_finds_the_nearest_centroid(spread):
    rng = np.random.default_rng(spread)
    for k in (1, 2, 17):
        X, C = rng.integers(-spread, spread + 1, (500, 8)), rng.integers(-spread, spread + 1, (k, 8))
        C = np.concatenate([C, C[:1]])
        X[:k + 1] = C
        number, best, _ = centroid_search.nearest(X, C)
        want, dist = _brute_nearest(X, C)
        assert (number == want).all() and (best == dist).all()


def test_scan_passes_centroids_over():
    """Vectors of different means and deviations need few exact distances."""
    rng = np.random.default_rng(0)
    level, width = rng.integers(-500, 500, (2000, 1)), rng.integers(1, 60, (2000, 1))
    X = level + rng.integers(-1000, 1001, (2000, 16)) * width // 100
    C = X[:200].copy()
    number, best, finished = centroid_search.nearest(X, C)
    want, dist = _brute_nearest(X, C)
    assert (number == want).all() and (best == dist).all() and finished < 0.3 * len(X) * len(C)


_VECTOR = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("cluster", T.StringType()), T.StructField("v", T.StringType())])


def _brute_clusters(rows, k=16, rounds=3, d=64):
    kept = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == d and all(x is not None and np.isfinite(x) for x in v)]
    ids = [i for i, _ in kept]
    X = np.array([v for _, v in kept], dtype=np.int64)
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    C = np.array([v for _, v in first], dtype=np.int64)
    for _ in range(rounds):
        number, _ = _brute_nearest(X, C)
        C = np.array([X[number == c].sum(axis=0) // (number == c).sum() if (number == c).any() else C[c] for c in range(len(C))])
    number, dist = _brute_nearest(X, C)
    sums = Counter()
    for c, x in zip(number.tolist(), dist.tolist(), strict=True):
        sums[c] += x
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in C.tolist()]
    return sorted(((i, c, x, sums[c], sum(sums.values()), sha[c]) for i, c, x in zip(ids, number.tolist(), dist.tolist(), strict=True)), key=repr)


def _vectors(n, seed=1):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    rows = [(k, [x + rng.gauss(0, 0.3) for x in rng.choice(base)]) for k in range(n)]
    bad = [0.5] * 63
    rows += [(None, base[0]), (None, None), (900, None), (901, bad), (902, [*bad, None]), (903, [*bad, float("nan")]), (904, [*bad, float("-inf")]),
             (905, [*bad, 0.5, 0.5]), (906, []), (3, base[1]), (3, base[2]), (907, base[0]), (907, base[0])]
    return [(*r, None, "x", "y") for r in rows]


@pytest.mark.parametrize("n", [150, 4])
def test_clusters_against_brute_force(spark, n):
    rows = _vectors(n)
    got = centroid_search.cluster(spark.createDataFrame(rows, _VECTOR).repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == _brute_clusters(rows)


def test_clusters_of_copies_of_one_vector(spark):
    rows = [(k, [0.25] * 64, None, "x", "y") for k in range(50)]
    got = centroid_search.cluster(spark.createDataFrame(rows, _VECTOR)).collect()
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in got} == {(0, 0, 0)} and len(got) == 50


def test_clusters_of_no_vectors(spark):
    for rows in ([], [(1, [0.5], None, "x", "y")], [(None, [0.5] * 64, None, "x", "y")]):
        df = centroid_search.cluster(spark.createDataFrame(rows, _VECTOR))
        assert df.collect() == [] and df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_components_beyond_the_bound_are_an_error(spark):
    rows = [(k, [float(2**40 * (k + 1))] + [0.0] * 63, None, "x", "y") for k in range(3)]
    with pytest.raises(Exception, match="would not fit 64 bits"):
        centroid_search.cluster(spark.createDataFrame(rows, _VECTOR)).collect()
