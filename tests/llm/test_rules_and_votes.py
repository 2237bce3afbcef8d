"""Quality rules, neighbour voting and the licence scan."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import knn_quality, license_scan, quality_rules as Q
from tests.llm.conftest import SCHEMA, prose


def brute_counts(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    seen = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    inside = {k + j for k in range(len(words) - 2) if seen[tuple(words[k:k + 3])] > 1 for j in range(3)}
    lines, earlier, doubled = (text or "").split("\n"), set(), 0
    for line in lines:
        if line.strip(" \t\n\v\f\r"):
            doubled += line in earlier
            earlier.add(line)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), doubled, len(inside))


@given(st.lists(st.sampled_from(["a", "b", "#x", "é|", " ", "  ", "\n", "\t", " ", "A!"]), max_size=60).map("".join))
@settings(max_examples=400, deadline=None)
def test_counts(text):
    assert Q.measures(text)[:5] == brute_counts(text)


@pytest.mark.parametrize("n,p", [(10, 0.1), (200, 0.02), (5000, 0.02)])
def test_binomial_tail(n, p):
    pmf = [math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
           for k in range(40 if n > 40 else n + 1)]
    for k in (0, 1, 5, min(30, n - 1)):
        assert math.isclose(Q.binomial_tail(k, n, p), min(1.0, sum(pmf[:k + 1])), rel_tol=1e-9)
    assert Q.binomial_tail(n, n, p) == 1.0


def test_levels_hold_the_risk():
    """Over many simulated holdouts a level whose true rate exceeds alpha is
    accepted in at most an ``error`` share of them."""
    rng, wrong = np.random.default_rng(1), 0
    for _ in range(400):
        good = rng.binomial(500, [0.001, 0.005, 0.03, 0.05])
        level = Q.pick_level(np.maximum.accumulate(good).tolist(), 500, [1, 2, 3, 4], 0.02, 0.05)
        wrong += level is not None and level >= 2
    assert wrong <= 400 * 0.05
    assert Q.pick_level([0, 0], 20, [1, 1], 0.02, 0.05) is None
    assert Q.pick_level([0, 0, 0], 5000, [10, 99, 100], 0.02, 0.05) == 1


def test_judge_and_keep(spark, awkward, empty):
    df, rows = awkward
    rng = random.Random(3)
    more = [(1000 + k, prose(rng, 120), "en", None, *["x"] * 14) for k in range(400)]
    more += [(2000 + k, "\n".join(["THE SAME!! LINE!!"] * 40), "en", None, *["x"] * 14) for k in range(60)]
    docs = spark.createDataFrame(rows + more, SCHEMA)
    labels = spark.createDataFrame([(1000 + k, 1) for k in range(400)] + [(2000 + k, 0) for k in range(60)] + [(None, 1), (1001, None), (1000, 1)],
                                   "doc_id long, quality int")
    out = Q.judge(docs, labels).collect()
    counts = Counter((r[0], *brute_counts(r[1])) for r in rows + more)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out) == counts
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in out)
    assert all(r.kept == (not r.base_failed and not r.failed_rules) for r in out)
    by = {r.doc_id: r for r in out}
    assert all(by[1000 + k].kept for k in range(400)) and not any(by[2000 + k].kept for k in range(60))
    kept = Q.keep(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in out if r.kept)
    none = labels.limit(0)
    assert {r.kept == (not r.base_failed) for r in Q.judge(df, none).collect()} == {True}
    assert Q.judge(empty, labels).count() == 0 and Q.keep(empty, labels).count() == 0


def test_calibration_reads_every_label(spark, monkeypatch):
    """A stratum with just enough good labels gets its level however many
    labels there are in all (a bound on them used to thin it out)."""
    monkeypatch.setattr(Q, "MAX_LABELS", 500, raising=False)
    measure = {c: 0 for c in Q._COUNTS} | {r: 0.0 for r in Q.RULES} | {"n_words": 100}
    rows = [(k, "big" if k < 4000 else "small", k % 10 != 0 if k < 4000 else k < 4300) for k in range(4400)]
    narrow = spark.createDataFrame([{"doc_id": k, "stratum": s, **measure, "capitals": 0.0 if good else 0.99} for k, s, good in rows])
    labels = spark.createDataFrame([(k, int(good)) for k, _, good in rows], "doc_id long, quality int")
    assert Q.calibrate(narrow, labels) == {"big": 0, "small": 0}


def test_votes_match_brute_force():
    rng = np.random.default_rng(2)
    texts = [prose(random.Random(k), 80) + (" ###!! $$" * 30 if k % 4 == 0 else "") for k in range(120)]
    rows = np.array([knn_quality.features(t) for t in texts])
    labels = np.array([int(k % 4 != 0) for k in range(120)])
    model = knn_quality.Neighbours(rows[:90], labels[:90])
    z = model._unit(model._weighted(rows[90:]) @ model.axes)
    got = model.score(rows[90:])
    for a, s in zip(z, got):
        cos = sorted(((float(a @ v), int(y)) for v, y in zip(model.vectors, model.labels)), reverse=True)
        cos = [c for c in cos if c[0] >= cos[knn_quality.NEIGHBOURS - 1][0] - 1e-5]
        w = [max(0.0, min(1.0, c)) ** 4 for c, _ in cos]
        expected = (sum(x * y for x, (_, y) in zip(w, cos)) + 0.1 * model.prior) / (sum(w) + 0.1)
        assert abs(s - expected) < 1e-3
    assert ((got >= 0.7) == (labels[90:] == 1)).mean() > 0.95
    assert rng is not None


@pytest.mark.parametrize("seed", range(4))
def test_tied_labels_all_vote_in_any_order(seed):
    """20 good and 20 bad copies of one text among others: half of the
    weight is good, whichever 25 stand first."""
    rng = random.Random(3)
    one, others = prose(rng, 100), [prose(rng, 100) for _ in range(60)]
    labelled = [(one, k % 2) for k in range(40)] + [(t, int(k % 3 > 0)) for k, t in enumerate(others)]
    random.Random(seed).shuffle(labelled)
    rows = np.array([knn_quality.features(t) for t, _ in labelled])
    model = knn_quality.Neighbours(rows, np.array([y for _, y in labelled]))
    got = model.score(np.array([knn_quality.features(one)]))[0]
    assert abs(got - (20 + 0.1 * model.prior) / 40.1) < 1e-3


def test_ids_of_labelled_documents_do_not_enter_a_score(spark):
    """The same texts and labels under other ids, half of them good and
    half bad copies of one text."""
    rng = random.Random(5)
    one = prose(rng, 100)
    texts = [(one, k % 2) for k in range(40)] + [(prose(rng, 100), k % 2) for k in range(60)]
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 != 2][:100]
    scores = []
    for order in (ids, ids[::-1]):
        docs = spark.createDataFrame([(i, t, None, None, *["x"] * 14) for i, (t, _) in zip(order, texts)], SCHEMA)
        labels = spark.createDataFrame([(i, y) for i, (_, y) in zip(order, texts)], "doc_id long, quality int")
        out = {r.doc_id: r.score for r in knn_quality.classify(docs, labels).collect()}
        scores.append([out[i] for i in order])
    assert np.allclose(*scores, atol=1e-4) and abs(scores[0][0] - 0.5) < 0.01


def test_votes_tell_texts_apart_by_vocabulary(spark):
    """Bad texts have the shapes, lengths and repetition of good ones, and
    half of their words; only the other words differ."""
    rng = random.Random(11)
    both, good, bad = ([f"{a}{b}{c}" for a in x for b in "aeiou" for c in ("lor", "mis", "nut")] for x in ("bcd", "fgh", "pqr"))
    rows = [(k, " ".join(rng.choice(both if rng.random() < 0.5 else bad if k % 3 == 0 else good) for _ in range(150)), None, None, *["x"] * 14)
            for k in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = knn_quality.classify(docs, spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(600)], "doc_id long, quality int")).collect()
    held = [r for r in out if r.held_out]
    assert len(held) > 100 and sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) > 0.95 * len(held)


def test_labels_of_absent_documents_take_no_place(spark, monkeypatch):
    monkeypatch.setattr(knn_quality, "MAX_LABELLED", 30)
    docs = spark.createDataFrame([(k, prose(random.Random(k), 80), None, None, *["x"] * 14) for k in range(60)], SCHEMA)
    labels = spark.createDataFrame([(k, k % 2) for k in range(5000)], "doc_id long, quality int")
    assert len(knn_quality.fit(docs, labels).labels) == 30


def test_classify(spark, awkward, empty):
    df, rows = awkward
    labels = spark.createDataFrame([(k, int(k % 5 > 0)) for k in range(40)] + [(108, 0), (109, 0), (None, 0), (3, None)], "doc_id long, quality int")
    out = knn_quality.classify(df, labels).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    assert all(0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.7) for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    scores = {}
    for r in out:
        scores.setdefault(r.doc_id, set()).add(round(r.score, 9))
    assert len({s for i in (100, 101, 102) for s in scores[i]}) == 1 and scores[104] <= scores[0] | scores[None]
    none = knn_quality.classify(df, labels.limit(0)).collect()
    assert {r.score for r in none} == {1.0}
    assert knn_quality.keep(df, labels).columns == df.columns
    assert knn_quality.classify(empty, labels).count() == 0 and knn_quality.classify(empty, labels.limit(0)).count() == 0


def test_held_out_labels_are_never_read(spark, awkward):
    df, _ = awkward
    labels = [(k, int(k % 5 > 0)) for k in range(40)]
    flipped = [(k, 1 - q if zlib.crc32(str(k).encode()) % 4 == 2 else q) for k, q in labels]
    assert labels != flipped
    a, b = (sorted((r.doc_id or -1, r.score) for r in knn_quality.classify(df, spark.createDataFrame(x, "doc_id long, quality int")).collect())
            for x in (labels, flipped))
    assert a == b


def test_license_scan(spark, awkward, empty):
    df, rows = awkward
    rng = random.Random(8)
    planted = [(500, "MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
               (501, "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
               (502, "GPL", "This work is licensed under the GNU General Public License, version 3."),
               (503, "CC-BY-NC", "Licensed under CC BY-NC 4.0."), (504, "CC-BY-SA", "licensed under CC BY-SA 4.0"),
               (505, "BSD", prose(rng, 70).replace("\n", " ") + " Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met " + prose(rng, 40).replace("\n", " "))]
    clean = [(600 + k, prose(rng, 90) + "\nThis project is about the version of the work that is under way.") for k in range(30)]
    extra = [(i, prose(rng, 60) + "\n" + t + "\n" + prose(rng, 30), None, None, *["x"] * 14) for i, _, t in planted]
    extra += [(i, t, None, None, *["x"] * 14) for i, t in clean]
    out = license_scan.scan(spark.createDataFrame(rows + extra, SCHEMA)).collect()
    found = {(r.doc_id, r.family) for r in out}
    assert found == {(i, f) for i, f, _ in planted}
    assert all(r.paragraph == 5 and r.similarity >= license_scan.SIMILAR and 0 < r.probability <= 1 for r in out)
    assert license_scan.scan(df).count() == 0 and license_scan.scan(empty).count() == 0


def test_spdx_tags_inside_longer_lines(spark, awkward):
    rng, rows = random.Random(9), awkward[1]
    tags = {f: t for f, ts in license_scan.TEMPLATES.items() for t in ts if t.startswith("SPDX")}
    planted = [(700 + k, {f}, f"Copyright 2020 Ann. {t}") for k, (f, t) in enumerate(tags.items())]
    planted += [(730, {"MIT", "Apache-2.0"}, "SPDX-License-Identifier: MIT OR Apache-2.0"),
                (731, {"ISC", "BSD", "MPL-2.0"}, "// SPDX-License-Identifier: (ISC AND BSD-3-Clause) OR MPL-2.0"),
                (732, {"GPL"}, "SPDX-License-Identifier: GPL-3.0-or-later WITH MIT exception"),
                (733, {"MIT"}, prose(rng, 90).replace("\n", " ") + " SPDX-License-Identifier: MIT " + prose(rng, 60).replace("\n", " ")),
                (734, set(), "SPDX-License-Identifier: Strange and the MIT of the work")]
    docs = spark.createDataFrame(rows + [(i, t, None, None, *["x"] * 14) for i, _, t in planted], SCHEMA)
    out = license_scan.scan(docs).collect()
    assert {(r.doc_id, r.family) for r in out} == {(i, f) for i, fs, _ in planted for f in fs}
    assert len(out) == sum(len(fs) for _, fs, _ in planted)


def test_every_family_of_a_line(spark, awkward):
    rng, rows = random.Random(10), awkward[1]
    planted = [({"MIT", "Apache-2.0"}, "Licensed under the MIT License or the Apache License, Version 2.0."),
               ({"MIT", "BSD"}, "Released under the MIT License. Released under the BSD license."),
               ({"ISC", "CC-BY"}, "Licensed under the ISC License, and the texts are licensed under CC BY 4.0."),
               ({"LGPL"}, "Licensed under the GNU Lesser General Public License, version 3."),
               ({"AGPL"}, "Licensed under the GNU Affero General Public License, version 3."),
               ({"CC-BY-SA"}, "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
               (set(), "This project is licensed under the usual terms of the work or the other license.")]
    docs = spark.createDataFrame(rows + [(800 + k, t + "\n" + prose(rng, 40), None, None, *["x"] * 14) for k, (_, t) in enumerate(planted)], SCHEMA)
    out = license_scan.scan(docs).collect()
    assert {(r.doc_id, r.family) for r in out} == {(800 + k, f) for k, (fs, _) in enumerate(planted) for f in fs}
    assert len(out) == sum(len(fs) for fs, _ in planted) and all(r.similarity >= license_scan.SIMILAR for r in out)


@pytest.mark.parametrize("families, line", [
    ({"MIT"}, "MIT License"),
    ({"GPL"}, "Licensed under GPLv3"),
    ({"Apache-2.0"}, "Apache License Version 2.0, January 2004"),
    ({"GPL"}, "This software is released under the terms of the GNU GPL v2"),
    ({"EPL"}, "EPL-2.0"),
    ({"GPL"}, "SPDX-License-Identifier: GPL-2.0-only"),
    ({"EPL"}, "SPDX-License-Identifier: EPL-2.0"),
    ({"BSD"}, "SPDX-License-Identifier: BSD-2-Clause"),
    ({"GPL"}, "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ({"LGPL"}, "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ({"AGPL"}, "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ({"MIT"}, 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
              "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ({"BSD"}, "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
              "in the documentation and/or other materials provided with the distribution."),
    ({"MIT", "GPL"}, "Dual licensed under the MIT License and GPL-2.0-or-later."),
    (set(), "SPDX-License-Identifier: Strange-1.0"),
    (set(), "The MIT press licensed the general public to read it under other terms."),
])
def test_common_names_titles_and_paragraphs(model_of_prose, families, line):
    assert {f for _, _, f, _, _ in model_of_prose.scan("Some words before it.\n" + line + "\nand after")} == families


@pytest.fixture(scope="module")
def model_of_prose():
    rng = random.Random(12)
    return license_scan.Model(license_scan.TEMPLATES, [prose(rng, 30).replace("\n", " ") for _ in range(300)])


def test_every_template_names_its_family_alone(model_of_prose):
    for family, templates in license_scan.TEMPLATES.items():
        for t in templates:
            assert {f for _, _, f, _, _ in model_of_prose.scan(t)} == {family}, t
