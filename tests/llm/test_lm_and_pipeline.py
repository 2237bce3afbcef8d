"""Language model against brute-force counts, and the pipeline's stages."""

import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from cohortlens.llm import jaccard_join, maxent_lm as LM
from tests.conftest import SF001
from tests.llm.conftest import SCHEMA
from tests.llm.test_groups import brute_components, shingles


def brute(rows):
    """(id, held, tokens, known, N, base score) of each row."""
    token = lambda t: (t or "").encode().lower().split() + [b"\n end"]
    held = lambda i: (zlib.crc32(str(i).encode()) if i is not None else 0) % 10 == 0
    counts = Counter(w for r in rows if not held(r[0]) for w in token(r[1]))
    total, norm = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    out = Counter()
    for r in rows:
        w = token(r[1])
        out[r[0], held(r[0]), len(w), sum(counts[x] > 0 for x in w), total,
            round(sum(math.log10((counts[x] + 0.1) / norm) for x in w), 5)] += 1
    return out


def rows_of(out):
    return Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out)


@pytest.mark.parametrize("chunk", [2000, LM.CHUNK_BYTES])
def test_counts_and_base(awkward, empty, monkeypatch, chunk):
    monkeypatch.setattr(LM, "CHUNK_BYTES", chunk)
    df, rows = awkward
    out = LM.score(df).collect()
    assert rows_of(out) == brute(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    assert LM.score(empty).count() == 0


def test_model_beats_the_base(spark):
    rng = random.Random(1)
    after = {w: rng.sample(range(60), 4) for w in range(60)}
    rows = []
    for i in range(400):
        w, words = rng.randrange(60), []
        for _ in range(80):
            words.append(f"word{w}")
            w = rng.choice(after[w])
        rows.append((i, " ".join(words), None, None, *["x"] * 14))
    out = LM.score(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)  # log scores are negative
    assert sum(r.score > r.base_score for r in held) > 0.9 * len(held)


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    out = LM.score(spark.createDataFrame([(i, "a b", None, None, *["x"] * 14) for i in ids], SCHEMA)).collect()
    assert all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in out)


def test_class_model_sums_to_one_and_learns():
    rng = np.random.default_rng(3)
    words = rng.integers(64, 1 << 62, 30).astype(np.uint64)
    text = words[rng.integers(0, 30, 4000)]
    text[1::2] = text[0::2]  # every word is followed by itself
    flat, at = LM.sequence([text])
    kinds = {int(w): k % LM.CLASSES for k, w in enumerate(words)} | {LM.END: 0, LM.BEFORE: 0}
    y = np.array([kinds[int(w)] for w in flat[at + 2]])
    rows = LM.features(flat)[:, at]
    model = LM.ClassModel(np.zeros(LM.CLASSES))
    before = model.log10(rows, y).mean()
    squares, met = np.ones((LM.ROWS, LM.CLASSES), np.float32), np.zeros(LM.ROWS, np.int64)
    for _ in range(30):
        model.steps(rows, y, squares, met)
    assert model.log10(rows, y).mean() > before + 0.3
    assert np.allclose(model._chances(rows[:, :50]).sum(axis=1), 1.0, atol=1e-4)
    assert met.sum() == 30 * LM.TEMPLATES * len(y)


def test_stages_take_effect(spark):
    docs = corpus_pipeline.documents(spark, SF001)
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.written(stage(spark, before, SF001), name)
        assert after.columns == docs.columns
        had, has = Counter(r.doc_id for r in before.collect()), Counter(r.doc_id for r in after.collect())
        assert has and not has - had
        if name == "ngram_jaccard_join":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            expected = {c[2] for c in brute_components([r for r in rows if shingles(r[1], 5)], 5, 80)}
            assert set(has) == expected | {i for i, t in rows if not shingles(t, 5)}
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF001).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in before.select("doc_id").collect()}
    whole = corpus_pipeline.run(spark, SF001).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in whole) == Counter(
        (r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)


def test_each_stage_rejects_rows_that_no_earlier_one_rejects(spark, tmp_path):
    """Short texts fall to the rules, texts of a bad vocabulary (of good
    shape) to the classifier, near copies to the join; the rest is packed."""
    rng = random.Random(21)
    both, good, bad = ([f"{a}{b}{c}" for a in x for b in "aeiou" for c in ("lor", "mis", "nut")] for x in ("bcd", "fgh", "pqr"))
    text = lambda own: " ".join(rng.choice(both if rng.random() < 0.5 else own) for _ in range(150))
    texts = {k: text(bad if k % 3 == 0 else good) for k in range(600)}
    short = {1000 + k: " ".join(texts[k].split()[:12]) for k in range(20)}
    near = {2000 + k: " ".join([*texts[3 * k + 1].split()[:70], "changed", *texts[3 * k + 1].split()[71:]]) for k in range(30)}
    rows = [(i, t, "en", None, *["x"] * 14) for i, t in (texts | short | near).items()]
    spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(600)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = spark.createDataFrame(rows, SCHEMA), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, str(tmp_path)), name)
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    rules, votes, distinct, packed = kept
    assert rules == set(texts) | set(near)
    wrong = {k for k in texts if k % 3 == 0}
    assert len(votes & wrong) < 0.05 * len(wrong) and len((rules - wrong) - votes) < 0.03 * len(rules)
    copied = {i for i in near if i in votes and 3 * (i - 2000) + 1 in votes}
    assert len(copied) > 25 and distinct == votes - copied and packed == distinct


def test_stages_handle_awkward_rows(spark, awkward, empty):
    docs, rows = awkward
    for first in (docs, empty):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, first, SF001)
            assert out.count() <= len(rows) + 20
    assert jaccard_join.keep_one(docs).columns == docs.columns


def test_words_in_a_class_follow_the_previous_word(spark):
    """All words have one shape and are equally frequent, so neither the
    classes nor the counts tell the successor; the previous word does."""
    rng = random.Random(4)
    names = [f"w{k:03d}x" for k in range(300)]
    after = dict(zip(names, rng.sample(names, len(names))))
    rows = []
    for i in range(400):
        words = [rng.choice(names)]
        for _ in range(59):
            words.append(after[words[-1]])
        rows.append((i, " ".join(words), None, None, *["x"] * 14))
    out = LM.score(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()
    held = [r for r in out if r.held_out]
    assert held and sum(r.score for r in held) / sum(r.n_tokens for r in held) > -0.5  # 1/300 is -2.48


def test_shares_after_a_word_sum_to_one():
    rng = np.random.default_rng(7)
    before = rng.integers(0, 5, 4000).astype(np.uint64) * np.uint64(1 << 40) + np.uint64(64)
    word = (rng.zipf(1.5, 4000) % 400).astype(np.uint64) * np.uint64(1 << 30)
    shapes = (word >> np.uint64(30)).astype(np.int64) % 3
    key = LM.pair_key(word, shapes)
    head = LM.pair_key(np.array([1 << 30], np.uint64), np.array([1]))
    share, left = LM.followers(before, key, np.ones(4000, np.uint32), head)
    sums, rest = Counter(), {}
    for b, k, s, x, r in sorted({*zip(before.tolist(), key.tolist(), shapes.tolist(), share.tolist(), left.tolist())}):
        sums[b, s] += x
        assert rest.setdefault((b, s), r) == r
        assert x == 0 or k != int(head[0])
    assert all(abs(sums[g] + rest[g] - 1) < 1e-5 for g in rest) and min(rest.values()) < 0.5


def test_model_size():
    """64 classes, four features, and rows that grow with the tokens."""
    assert LM.CLASSES == 64 and LM.TEMPLATES == 4
    assert LM.row_bits(1000) == 14 and LM.row_bits(5 * 10 ** 9) >= 19
    flat, at = LM.sequence([np.arange(100, 120, dtype=np.uint64), np.arange(200, 210, dtype=np.uint64)])
    other = flat.copy()
    other[at[8] + 2 - 3] += np.uint64(1)  # three back
    assert (LM.features(flat, 20)[3, at[8]] != LM.features(other, 20)[3, at[8]]) and LM.features(flat, 20).max() >= 1 << 16


def test_what_is_written_is_smaller_than_the_texts(spark, monkeypatch):
    """Word numbers and counts are packed; pairs are written nowhere, and
    those with known shares don't travel."""
    rng, sizes, real = random.Random(8), [], LM.written
    texts = [" ".join(f"word{int(rng.paretovariate(0.7)) % 20_000}" for _ in range(400)) for _ in range(300)]

    def written(df, name):
        out = real(df, name)
        sizes.append(sum(os.path.getsize(f.removeprefix("file:").replace("///", "/")) for f in out.inputFiles()))
        return out

    monkeypatch.setattr(LM, "written", written)
    rows = [(i, t, None, None, *["x"] * 14) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(1)
    assert rows_of(LM.score(df).collect()) == brute(rows)
    assert sum(sizes) < 0.25 * sum(map(len, texts))


def test_pairs_that_stay_have_known_shares():
    """A previous word with one training token leaves all to what is known
    without it, whatever followed it."""
    before, key = np.array([7 << 20, 9 << 20, 9 << 20], np.uint64), np.array([3 << 5, 3 << 5, 4 << 5], np.uint64)
    share, left = LM.followers(before, key, np.array([1, 0, 0], np.uint32), np.zeros(0, np.uint64))
    assert share.tolist() == [0, 0, 0] and left.tolist() == [1, 1, 1]
    flat, lengths = np.array([0, 1, 2, 1, 0], np.uint32), np.array([3, 0, 2])
    told, places = LM.pair_places(flat, lengths, np.array([True, False, True, True]), np.array([True, False, False]))
    assert told.tolist() == [False, True, False, True, False] and places.tolist() == [0 * 4 + 1, 3 * 4 + 1]
    numbers = np.array([5, 1 << 40, 0], np.uint64), np.array([True, False])
    assert all((a == b).all() for a, b in zip(LM.unpacked(LM.packed(*numbers), np.uint64, np.bool_), numbers, strict=True))


def test_row_sums_add_as_one_reduction_does():
    """The training step's sums by row of the table, to the last bit."""
    rng = np.random.default_rng(8)
    for rows in (1, 3, 700, 5000):
        row = np.minimum(rng.integers(0, rows, 4096), rng.integers(0, rows, 4096)).astype(np.uint16)
        g = rng.normal(size=(len(row), LM.CLASSES)).astype(np.float32)
        order = np.argsort(row, kind="stable")
        first = np.flatnonzero(np.diff(row[order].astype(np.int64), prepend=-1))
        plain = np.add.reduceat(np.ascontiguousarray(g[order].T), first, axis=1).T
        assert np.array_equal(LM.row_sums(g, order, first, np.diff(first, append=len(order))), plain)
