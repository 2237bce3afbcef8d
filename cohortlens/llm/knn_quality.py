"""Quality classifier by nearest-neighbour voting in a latent space.

A text becomes a bag of its *words*, single and in pairs, hashed into
``WORDS`` columns, a bag of *shapes*: its words with letters, digits and runs
reduced to classes, single and in pairs, hashed into ``FEATURES`` columns,
and bands of how much the text repeats words, word triples and lines. A
truncated SVD of the weighted matrix of a bounded sample of labelled
documents gives the latent axes. The sample's latent vectors and labels
(at most ``MAX_LABELLED`` rows of ``AXES`` numbers) go to every task, which
computes the exact cosines of each block of documents with all of them in
one matrix product and lets the nearest ``NEIGHBOURS`` and all that are tied
with the last of them vote, weighted by similarity. Nothing but the text
enters a score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import small_batches

FEATURES, BANDS = 1024, 33
#: Half for words, half for pairs.
WORDS = 4096
COLUMNS = FEATURES + BANDS + WORDS
AXES = 64
#: Labelled rows that the model is fitted on and votes with, at most.
MAX_LABELLED = 8192
NEIGHBOURS = 25
#: Decimals of a cosine: what the rounding of the product leaves, so that
#: equal texts tie wherever they stand in it.
DECIMALS = 5
PREDICT = 0.7

_CLASSES = bytes(0x61 if b >= 128 or 97 <= b < 123 else 0x41 if 65 <= b < 91 else 0x30 if 48 <= b < 58 else b
                 for b in range(256))
#: Lower-case letters, digits and non-ASCII bytes make words.
_LETTERS = bytes(b + 32 if 65 <= b < 91 else b if b >= 128 or 97 <= b < 123 or 48 <= b < 58 else 32 for b in range(256))
_RUNS = re.compile(rb"([^\s])\1+")


@lru_cache(maxsize=1 << 16)
def _column(term: tuple) -> int:
    return zlib.crc32(b" ".join(term)) % FEATURES


def _word_counts(data: bytes) -> np.ndarray:
    """Shares (log scaled) of the hashed words and pairs of words."""
    h = np.array([zlib.crc32(w) for w in data.translate(_LETTERS).split()], dtype=np.uint64)
    half, k = np.uint64(WORDS // 2), np.uint64(0x9E3779B97F4A7C15)
    pairs = ((h[:-1] * k ^ h[1:]) * k >> np.uint64(33)) % half
    counts = np.bincount(np.concatenate([h % half, half + pairs]).astype(np.int64), minlength=WORDS)
    return np.log1p(1000.0 * counts / max(len(h), 1))


def features(text: str | None) -> np.ndarray:
    """Term counts (log scaled) and repetition bands of one text."""
    v = np.zeros(COLUMNS, dtype=np.float32)
    if not text:
        return v
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return v
    shapes = _RUNS.sub(rb"\1", data.translate(_CLASSES)).split()
    terms = Counter(zip(shapes))
    terms.update(zip(shapes, shapes[1:]))
    total = len(shapes)
    for term, n in terms.items():
        v[_column(term)] += np.log1p(1000.0 * n / total)
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    triples = list(zip(words, words[1:], words[2:]))
    for k, (whole, distinct) in enumerate(((len(words), len(set(words))), (len(triples), len(set(triples))),
                                           (len(lines), len(set(lines))))):
        share = 1.0 - distinct / whole if whole else 0.0
        v[FEATURES + 11 * k + int(10 * share)] = 1.0
    v[FEATURES + BANDS:] = _word_counts(data)
    return v


class Sparse:
    """Rows as places and values of what isn't zero; slices are dense, so
    the driver never holds the whole matrix."""

    def __init__(self, rows: list[tuple[bytes, bytes]]):
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, part: slice) -> np.ndarray:
        out = np.zeros((len(self.rows[part]), COLUMNS), dtype=np.float32)
        for row, (at, v) in zip(out, self.rows[part]):
            row[np.frombuffer(at, dtype=np.uint16)] = np.frombuffer(v, dtype=np.float32)
        return out


class Neighbours:
    """The fitted space with its labelled vectors; small enough to travel
    with each task (about ``MAX_LABELLED * AXES`` floats)."""

    def __init__(self, rows: np.ndarray | Sparse, labels: np.ndarray):
        self.labels = labels.astype(np.float32)
        self.prior = float(self.labels.mean()) if len(labels) else 1.0
        if not len(labels):
            return
        seen = sum((rows[a:a + 512] > 0).sum(axis=0) for a in range(0, len(rows), 512))
        self.idf = (np.log((1.0 + len(rows)) / (1.0 + seen)) + 0.1).astype(np.float32)
        self.axes = self._top(rows)
        self.vectors = self._unit(np.concatenate([x @ self.axes for x in self._blocks(rows)]))

    def _blocks(self, rows: np.ndarray | Sparse) -> Iterator[np.ndarray]:
        for a in range(0, len(rows), 512):
            yield self._weighted(rows[a:a + 512])

    def _top(self, rows: np.ndarray | Sparse, turns: int = 12) -> np.ndarray:
        """Leading right singular vectors by subspace iteration."""
        basis = np.random.default_rng(1).standard_normal((COLUMNS, AXES + 32)).astype(np.float32)
        for _ in range(turns):
            basis, _ = np.linalg.qr(sum(x.T @ (x @ basis) for x in self._blocks(rows)))
        within = np.concatenate([x @ basis for x in self._blocks(rows)]).astype(np.float64)
        values, vectors = np.linalg.eigh(within.T @ within)
        keep = np.argsort(-values)[:AXES]
        return basis @ vectors[:, keep[values[keep] > 1e-9 * max(values.max(), 1e-30)]].astype(np.float32)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def _weighted(self, rows: np.ndarray) -> np.ndarray:
        """Shapes, bands and words weigh alike, whatever a text's length."""
        return np.hstack([self._unit(x) for x in np.split(rows * self.idf, [FEATURES, FEATURES + BANDS], axis=1)])

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(rows), self.prior)
        cosines = np.round(self._unit(self._weighted(rows) @ self.axes) @ self.vectors.T, DECIMALS)
        k = min(NEIGHBOURS, cosines.shape[1])
        # Every label tied with the last neighbour votes too, so their order
        # decides nothing.
        last = -np.partition(-cosines, k - 1, axis=1)[:, k - 1]
        row, near = np.nonzero(cosines >= last[:, None])
        weight = np.clip(cosines[row, near], 0.0, 1.0).astype(np.float64) ** 4
        total = np.bincount(row, weight, len(cosines))
        votes = np.bincount(row, weight * self.labels[near], len(cosines))
        return np.round(np.clip((votes + 0.1 * self.prior) / (total + 0.1), 0.0, 1.0), 6)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")), F.lit(0)) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame) -> Neighbours:
    """Fit on labelled documents of ``docs`` that are not held out: at most
    ``MAX_LABELLED``, drawn by a hash of their id. Of several labels of a
    document the lowest counts, of several texts the first in order."""
    small_batches(docs.sparkSession)
    marked = (labels.filter("doc_id is not null and quality is not null").filter(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    present = marked.join(docs.select("doc_id"), "doc_id", "left_semi")
    sample = present.orderBy(F.xxhash64(F.lit("labelled"), "doc_id"), "doc_id").limit(MAX_LABELLED)
    texts = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most MAX_LABELLED rows
             .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality")))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            vectors = [features(t) for t in pdf["text"]]
            at = [np.flatnonzero(v) for v in vectors]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "quality": pdf["quality"], "at": [a.astype(np.uint16).tobytes() for a in at],
                                "v": [v[a].tobytes() for v, a in zip(vectors, at)]})

    found = texts.mapInPandas(extract, "doc_id long, quality int, at binary, v binary").collect()
    # Ordered by what they say: ids have no part in the space either.
    found.sort(key=lambda r: (bytes(r["at"]), bytes(r["v"]), r["quality"]))
    rows = Sparse([(bytes(r["at"]), bytes(r["v"])) for r in found])
    return Neighbours(rows, np.array([r["quality"] for r in found]))


def score(text: Column, model: Neighbours) -> Column:
    """Quality score of each text, from 0 to 1."""
    shared = model

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.score(np.array([features(t) for t in texts])) if len(texts) else [], dtype="float64")
    return scored(text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    Null, empty and wordless texts have no direction in the space and get
    the share of good labels; so does every text when there is no label of
    the other kind, and 1.0 when there is no label at all. Equal texts get
    equal scores. Rows without doc_id are not held out. Other columns
    (labels, language, source) are never read."""
    model = fit(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= PREDICT).cast("int"))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are predicted good. Scores
    are those of ``classify``: null, empty and wordless texts have the share
    of good labels, so they stay while that is ``PREDICT`` or more; equal
    texts, repeated rows too, stay or go together, whatever their id; without
    labels everything stays, and an empty table stays empty."""
    return docs.filter(score(F.col("text"), fit(docs, labels)) >= PREDICT)
