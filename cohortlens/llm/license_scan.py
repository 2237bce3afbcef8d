"""Licence scan: a trained paragraph classifier confirmed by templates.

Paragraphs are lines; long ones are read in overlapping windows. A
multinomial logistic regression over sparse word 1- and 2-grams assigns a
licence family or the unknown class. It is trained here on the templates,
on parts and noisy copies of them, and for the unknown class on paragraphs
of the corpus (a bounded sample) and on templates whose family words were
replaced. Half of the made examples calibrate it: a temperature for the
probabilities, and the least probability at which a family is believed,
so that no more than ``FALSE_SHARE`` of the unknown ones pass. A believed
family is reported once a template of it shares ``SIMILAR`` of its word
3-grams with the paragraph. Templates of fewer words (SPDX tags) are looked
for whole, anywhere in a paragraph, and each identifier of an SPDX expression
counts as a tag. Paragraphs without a template 3-gram or a short template
could not be confirmed and are skipped before scoring. A window may name
several families while its probability is for one: the words that a template
has in common with a paragraph are therefore scored by themselves as well.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import sampled_texts, small_batches
from cohortlens.llm.license_templates import TEMPLATES

UNKNOWN = "unknown"
#: Documents of which up to three windows each serve as unknown examples.
MAX_SAMPLE = 1000
WINDOW, STEP = 48, 24
COPIES = 16
SIMILAR = 0.6
#: Distance of two 3-grams up to which they belong to one passage.
GAP = 3
FALSE_SHARE = 0.002

#: What an SPDX expression starts with and what joins its parts.
TAG, JOINTS = "spdx-license-identifier", ("or", "and", "with")

_WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(words: list[str], n: int) -> set[tuple]:
    return set(zip(*[words[k:] for k in range(n)])) if len(words) >= n else {tuple(words)} if words else set()


def windows(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Windows of ``WINDOW`` words that together cover the paragraph."""
    at = 0
    while True:
        yield at, words[at:at + WINDOW]
        if at + WINDOW >= len(words):
            return
        at += STEP


class Model:
    """Trained on the driver from bounded examples; travels with tasks."""

    def __init__(self, templates: dict[str, tuple[str, ...]], corpus: list[str], seed: int = 1):
        rng = random.Random(seed)
        self.families = [UNKNOWN, *templates]
        self.templates = {f: [grams(words_of(t), 3) for t in ts] for f, ts in templates.items()}
        self.known = set().union(*[g for gs in self.templates.values() for g in gs])
        self.where: dict[tuple, list[tuple[str, int]]] = {}
        for f, sets in self.templates.items():
            for number, gs in enumerate(sets):
                for g in gs:
                    self.where.setdefault(g, []).append((f, number))
        self.short = {f: {g for gs in s for g in gs if len(g) < 3} for f, s in self.templates.items()}
        self.tags = set().union(*self.short.values())
        self.first = {g[0] for g in self.tags}
        examples = self._examples(templates, corpus, rng)
        rng.shuffle(examples)
        half = len(examples) // 2
        fit, held = examples[:half], examples[half:]
        counts = Counter(g for words, _ in fit for g in self._terms(words))
        self.columns = {g: i + 1 for i, g in enumerate(sorted(g for g, n in counts.items() if n > 1))}
        self.weights = np.zeros((len(self.columns) + 1, len(self.families)))
        self.bias = np.zeros(len(self.families))
        self._fit([self._vector(w) for w, _ in fit], np.array([y for _, y in fit]), rng)
        self._calibrate(held)

    def _examples(self, templates: dict, corpus: list[str], rng: random.Random) -> list[tuple[list[str], int]]:
        prose = [w for t in corpus for w in words_of(t)[:WINDOW]] or ["text"]
        out = [(w, 0) for t in corpus if (w := words_of(t)[:WINDOW]) and not self.similar(w, None)]
        in_families = Counter(w for ts in templates.values() for w in {x for t in ts for x in words_of(t)})
        for y, (_, texts) in enumerate(templates.items(), 1):
            for text in texts:
                words = words_of(text)
                out.append((words, y))
                for _ in range(COPIES):
                    noisy = [w for w in words if rng.random() > 0.05]
                    size = rng.randint(max(min(5, len(noisy)), len(noisy) * 2 // 3), len(noisy)) if noisy else 0
                    at = rng.randint(0, len(noisy) - size)
                    around = [rng.choice(prose) for _ in range(min(max(0, WINDOW - size), rng.choice((0, 2, rng.randint(0, size * 3 // 2)))))]
                    before = rng.randint(0, len(around))
                    out.append((around[:before] + noisy[at:at + size] + around[before:], y))
                own = [w for w in words if in_families[w] <= 2]
                for _ in range(COPIES // 2):
                    swap = {w: rng.choice(prose) for w in own}
                    mixed = [swap.get(w, w) for w in words]
                    if self.similar(mixed, None) < SIMILAR:  # else it still names a family
                        out.append((mixed, 0))
        return [(w, y) for w, y in out if w]

    @staticmethod
    def _terms(words: list[str]) -> list[tuple]:
        return [*zip(words), *zip(words, words[1:])]

    def _vector(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Columns and weights of a unit vector; unseen terms share column 0."""
        counts = Counter(self.columns.get(g, 0) for g in self._terms(words))
        at = np.fromiter(counts.keys(), dtype=np.int64, count=len(counts))
        x = np.log1p(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
        return at, x / max(np.linalg.norm(x), 1e-12)

    def _logits(self, vector: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        at, x = vector
        return x @ self.weights[at] + self.bias

    def _fit(self, vectors: list, y: np.ndarray, rng: random.Random, passes: int = 12) -> None:
        """Stochastic gradient steps with per-weight step sizes (Adagrad)."""
        squares, bias_squares = np.full_like(self.weights, 1e-3), np.full_like(self.bias, 1e-3)
        order = list(range(len(vectors)))
        for _ in range(passes):
            rng.shuffle(order)
            for i in order:
                at, x = vectors[i]
                z = self._logits(vectors[i])
                p = np.exp(z - z.max())
                p /= p.sum()
                p[y[i]] -= 1.0
                g = np.outer(x, p) + 1e-5 * self.weights[at]
                squares[at] += g * g
                self.weights[at] -= 0.5 * g / np.sqrt(squares[at])
                bias_squares += p * p
                self.bias -= 0.1 * p / np.sqrt(bias_squares)

    def _calibrate(self, held: list[tuple[list[str], int]]) -> None:
        """Temperature of least held-out loss, then the least believed
        probability."""
        self.temperature, self.least = 1.0, 0.5
        if not held:
            return
        z, y = np.array([self._logits(self._vector(w)) for w, _ in held]), np.array([c for _, c in held])

        def chances(t: float) -> np.ndarray:
            e = np.exp((z - z.max(axis=1, keepdims=True)) / t)
            return e / e.sum(axis=1, keepdims=True)

        loss = lambda t: -np.log(chances(t)[np.arange(len(y)), y] + 1e-12).mean()
        self.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
        wrong = chances(self.temperature)[y == 0][:, 1:].max(axis=1)
        if len(wrong):
            self.least = float(max(0.5, min(0.99, np.quantile(wrong, 1.0 - FALSE_SHARE))))

    def classify(self, words: list[str]) -> tuple[str, float]:
        """Family and calibrated probability; unknown if not believed."""
        z = self._logits(self._vector(words)) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return (self.families[best], float(p[best])) if best and p[best] >= self.least else (UNKNOWN, float(p[0]))

    def similar(self, words: list[str], family: str | None) -> float:
        """Largest share of 3-grams that the words have in common with one
        template (of one family), counted in the smaller of both."""
        tags = {g for _, g in self.short_templates(words)}
        if tags and not tags.isdisjoint(self.short[family] if family else self.tags):
            return 1.0
        own = grams(words, 3)
        if not own or (family is None and self.known.isdisjoint(own)):
            return 0.0
        sets = self.templates[family] if family else [g for gs in self.templates.values() for g in gs]
        return max(len(own & t) / min(len(own), len(t)) for t in sets)

    def short_templates(self, words: list[str]) -> list[tuple[int, tuple]]:
        """Where templates of one or two words start among the words; the
        later identifiers of an SPDX expression stand behind its start."""
        if self.first.isdisjoint(words):
            return []
        found = [(at, g) for n in (1, 2) for at, g in enumerate(zip(*[words[k:] for k in range(n)])) if g in self.tags]
        for at, word in enumerate(words):
            end = at + 2
            while word == TAG and words[end:end + 1] and words[end] in JOINTS and end + 1 < len(words):
                g = (TAG, words[end + 1])
                if words[end] != "with" and g in self.tags:
                    found.append((at, g))
                end += 2
        return found

    def passages(self, words: list[str]) -> list[tuple[str, int, int]]:
        """(family, start, end) of the words that hold ``SIMILAR`` of the
        3-grams of one template, at most ``GAP`` words apart. Families share
        sentences: a passage within one that has more 3-grams of another
        family's template is that family's."""
        hits: dict[tuple[str, int], list[int]] = {}
        for at, g in enumerate(zip(words, words[1:], words[2:])):
            for template in self.where.get(g, ()):
                hits.setdefault(template, []).append(at)
        found = []
        for (family, number), places in hits.items():
            size, begin = len(self.templates[family][number]), 0
            for k, at in enumerate(places, 1):
                if k == len(places) or places[k] - at > GAP:
                    part = words[places[begin]:at + 3]
                    shared = len(grams(part, 3) & self.templates[family][number])
                    if shared >= SIMILAR * size:
                        found.append((family, places[begin], at + 3, shared))
                    begin = k
        own = [(f, a, b) for f, a, b, n in found if not any(g != f and c <= a and b <= d and m > n for g, c, d, m in found)]
        return sorted(own, key=lambda x: (x[0], x[1] - x[2], x[1]))

    def scan(self, text: str | None) -> list[tuple]:
        """(paragraph, word, family, probability, similarity) of each
        window with a confirmed family; the best window of a paragraph and
        family counts."""
        found = []
        for number, line in enumerate(text.split("\n") if text else ()):
            words = words_of(line)
            tags = self.short_templates(words)
            if not tags and self.known.isdisjoint(zip(words, words[1:], words[2:])) and tuple(words) not in self.known:
                continue
            best: dict[str, tuple] = {}
            for at, part in windows(words):
                family, chance = self.classify(part)
                if family != UNKNOWN and (s := self.similar(part, family)) >= SIMILAR:
                    best[family] = max(best.get(family, (0.0, 0.0, 0)), (s, chance, -at))
            for named, at, end in self.passages(words):
                if named not in best:
                    family, chance = self.classify(words[at:end])
                    if family == named:
                        best[family] = (self.similar(words[at:end], family), chance, -at)
            for at, tag in tags:
                family, chance = self.classify(list(tag))
                if family not in best and tag in self.short.get(family, ()):
                    best[family] = (1.0, chance, -at)
            found += [(number, -at, f, chance, s) for f, (s, chance, at) in sorted(best.items())]
        return found


def train(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> Model:
    small_batches(docs.sparkSession)

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, " ".join(words_of(x)[:WINDOW])) for i, t in zip(pdf["doc_id"], pdf["text"]) if t
                    for x in sorted(set(t.split("\n")), key=len)[-3:]]
            yield pd.DataFrame(rows, columns=["doc_id", "line"])

    found = sampled_texts(docs, MAX_SAMPLE, "licences").mapInPandas(lines, "doc_id long, line string").collect()
    return Model(templates, sorted(r["line"] for r in found if r["line"]))


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """``doc_id, paragraph, word, family, probability, similarity``: one row
    per paragraph (line number from 0) and licence family found in it;
    ``word`` is where the best window starts.

    Whole texts are read. Null and empty texts have no paragraphs; repeated
    rows give repeated findings; a paragraph that names several families
    gives a row for each; other columns are ignored; an empty table gives an
    empty result."""
    model = train(docs, templates)

    @F.pandas_udf("array<struct<paragraph:int,word:int,family:string,probability:double,similarity:double>>")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("paragraph", "word", "family", "probability", "similarity")
        for texts in batches:
            yield pd.Series([[dict(zip(names, f)) for f in model.scan(t)] for t in texts], dtype=object)

    return docs.select("doc_id", F.explode(scanned(F.col("text"))).alias("f")).select("doc_id", "f.*")
