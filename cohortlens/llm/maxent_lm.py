"""Hashed maximum-entropy language model with a class-factored softmax.

``P(token | context) = P(class | context) * P(token | class)``.

*Classes.* The end of a text, the most frequent words (one class each) and
shape classes for all other words (non-ASCII or not, kind of last
character, length).

*Class model.* A softmax over sparse features of the context, each hashed
to a row of one weight table: the previous word (bigram), the previous two
together (trigram), and the words two and three back (skips). The table
has a row for each ``ROW_TOKENS`` training tokens, ``ROWS`` at least. Every task
runs minibatch gradient steps (Adagrad) over its share of the training
texts; the updates of all tasks are averaged, each row of the table by how
often the tasks met it.

*Words.* Within a shape class a known word has its share of the class's
training tokens; the share of tokens seen only once (Good-Turing) goes to
unknown words, one outcome per shape class. After each previous word, the
words of the class that followed it in training get their share of these
followers, and what followed only once is given back to the shares without
context. So the model sums to 1 over the known words and one unknown word
per shape, whatever the previous word.

*Counts* must be exact for every word, and the vocabulary grows with the
corpus, so it is never broadcast. Texts are read once into chunks of bounded
size with a dictionary each, and written as the chunk's word numbers. Each
chunk lists the hashes and training counts of its distinct words; the lists
meet in blocks of hashes, and only the totals return. By these, each chunk
lists its distinct pairs of neighbouring words. They grow with the corpus as
well and meet in blocks of previous words (hashed), and again only counts
return. A pair whose previous word has at most one training token, or whose
following word has a class of its own, has known shares (0 and 1, or none) and
doesn't travel. Numbers travel with their bytes by place, compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import parts_for, small_batches, text_bytes, written

HEAD = 39
SHAPES = 24
CLASSES = 1 + HEAD + SHAPES
#: Least size of the weight table, and training tokens for each row of it.
ROW_BITS = 14
ROWS = 1 << ROW_BITS
ROW_TOKENS = 1 << 14
TEMPLATES = 4
#: Rows of the weight table that travel together.
BLOCK_ROWS = 256
#: Text that one dictionary covers, and text that one training task reads.
CHUNK_BYTES, TRAIN_BYTES = 24 << 20, 512 << 20
#: Text whose pairs of words meet in one block.
PAIR_BYTES = 16 << 20
BATCH = 4096
RATE = 0.25
#: 64-bit stand-ins for the end and for what precedes a text.
END, BEFORE = 1, 2
_MAX_WORDS = 400_000


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 10, is 0 (so is a null id's)."""
    return F.coalesce(F.crc32(doc_id.cast("string")), F.lit(0)) % 10 == 0


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shape(word: bytes) -> int:
    last = word[-1]
    ending = 0 if last >= 128 or 97 <= last < 123 else 1 if last == 46 else 2 if last == 44 else 3
    length = 0 if len(word) <= 4 else 1 if len(word) <= 8 else 2
    return (0 if word.isascii() else 12) + ending * 3 + length


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def row_bits(tokens: int) -> int:
    """Bits of a row number of the weight table for so many training tokens."""
    return max(ROW_BITS, (max(tokens, 1) // ROW_TOKENS).bit_length())


def features(h: np.ndarray, bits: int = ROW_BITS) -> np.ndarray:
    """Rows of the weight table for each place of a sequence of word
    hashes; places count from the third (which is never predicted)."""
    one, two, three = h[1:-1], h[:-2], np.concatenate([h[:1], h[:-3]])
    k = [np.uint64(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for n in range(1, 5)]
    rows = np.stack([_mix(one + k[0]), _mix(two + k[1]), _mix(_mix(one + k[2]) + two), _mix(three + k[3])])
    return (rows >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)


def sequence(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One sequence of word hashes for several documents: three places of
    start before each and the end after it. Also the places to predict, as
    offsets into ``features``' columns."""
    start, end = np.full(3, BEFORE, np.uint64), np.full(1, END, np.uint64)
    flat = np.concatenate([p for d in docs for p in (start, d, end)])
    at = np.ones(len(flat), dtype=bool)
    begins = np.cumsum([0] + [len(d) + 4 for d in docs[:-1]])
    for k in range(3):
        at[begins + k] = False
    return flat, np.flatnonzero(at) - 2


_ONES = np.ones(CLASSES, np.float32)

#: Gradients of one row of the table that are added one after the other, in
#: the order in which ``reduceat`` adds so few.
_FEW = 8


def row_sums(g: np.ndarray, order: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of rows of ``g`` over segments of ``order``, all of them not
    empty. Most segments are short: these add whole rows of all segments at
    once, and only long ones are turned to be reduced along memory."""
    sums = g.take(order[first], axis=0)
    short = np.flatnonzero((lengths > 1) & (lengths <= _FEW))
    if len(short):
        begin, size = first[short], lengths[short]
        rest = g.take(order[begin + 1], axis=0)
        for k in range(2, size.max()):
            own = np.flatnonzero(size > k)
            rest[own] += g.take(order[begin[own] + k], axis=0)
        sums[short] += rest
    long = np.flatnonzero(lengths > _FEW)
    if len(long):
        turned = np.ascontiguousarray(g.take(order[np.repeat(lengths > _FEW, lengths)], axis=0).T)
        sums[long] = np.add.reduceat(turned, np.cumsum(lengths[long]) - lengths[long], axis=1).T
    return sums


class ClassModel:
    """Softmax over the classes; ``2^bits x 64`` weights."""

    def __init__(self, bias: np.ndarray, weights: np.ndarray | None = None, bits: int = ROW_BITS):
        self.bias = bias.astype(np.float32)
        self.weights = np.zeros((1 << bits, CLASSES), np.float32) if weights is None else weights
        self.bits = len(self.weights).bit_length() - 1

    def _chances(self, rows: np.ndarray) -> np.ndarray:
        z = self.weights.take(rows[0], axis=0)
        more = np.empty_like(z)
        for k in range(1, TEMPLATES):
            z += self.weights.take(rows[k], axis=0, out=more, mode="clip")
        z += self.bias
        np.clip(z, -60.0, 60.0, out=z)
        np.exp(z, out=z)
        z *= (1.0 / (z @ _ONES))[:, None]
        return z

    def log10(self, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.empty(len(y))
        for a in range(0, len(y), BATCH):
            p = self._chances(rows[:, a:a + BATCH])
            out[a:a + BATCH] = np.log10(p[np.arange(len(p)), y[a:a + BATCH]].astype(np.float64) + 1e-30)
        return out

    def steps(self, rows: np.ndarray, y: np.ndarray, squares: np.ndarray, met: np.ndarray) -> None:
        """One gradient step for each ``BATCH`` places."""
        for a in range(0, len(y), BATCH):
            part = rows[:, a:a + BATCH]
            g = self._chances(part)
            g[np.arange(len(g)), y[a:a + BATCH]] -= 1.0
            for k in range(TEMPLATES):
                order = np.argsort(part[k], kind="stable")  # radix sort of 16-bit rows
                row = part[k][order]
                first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                lengths, row = np.diff(first, append=len(order)), row[first]
                sums = row_sums(g, order, first, lengths)
                total = squares.take(row, axis=0)
                total += sums * sums
                squares[row] = total
                sums *= RATE
                sums /= np.sqrt(total, out=total)
                self.weights[row] -= sums
                met[row] += lengths


class Numbers(dict):
    """Numbers distinct words in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Words(dict):
    """word -> hash with the class in the low six bits, for a known head."""

    def __init__(self, head: dict[int, int]):
        self.head = head

    def __missing__(self, word: bytes) -> int:
        h = word_hash(word)
        coded = self[word] = h | class_of(h, shape(word), self.head)
        return coded

    def code(self, words: list[bytes]) -> np.ndarray:
        if len(self) > _MAX_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def word_hash(word: bytes) -> int:
    """64 bits, the low six left to the class."""
    return max(xxhash.xxh3_64_intdigest(word) & ~63, 64)


def class_of(h: int, s: int, head: dict[int, int]) -> int:
    return head.get(h, 1 + HEAD + s)


# -- passes over the corpus ------------------------------------------------


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as one compressed value: first the lowest bytes of
    all numbers and last the highest, which are mostly 0."""
    body = b"".join(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in arrays)
    return np.array([len(body), *map(len, arrays)], np.int64).tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def unpacked(value: bytes, *types) -> list[np.ndarray]:
    size, *counts = np.frombuffer(value, np.int64, len(types) + 1).tolist()
    body = pa.decompress(value[8 * len(types) + 8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    out, at = [], 0
    for n, t in zip(counts, map(np.dtype, types), strict=True):
        part = np.frombuffer(body, np.uint8, n * t.itemsize, at).reshape(t.itemsize, n)
        out.append(np.ascontiguousarray(part.T).view(t).ravel())
        at += n * t.itemsize
    return out


_CHUNKS = "chunk long, docs binary, block int, h binary, number binary, shape binary, n binary"
_ARROW = {"chunk": pa.int64(), "docs": pa.binary(), "block": pa.int32(), "h": pa.binary(), "number": pa.binary(), "shape": pa.binary(), "n": pa.binary()}
_DOCS = np.int64, np.bool_, np.bool_, np.uint32, np.uint32


def _chunks(docs: DataFrame, blocks: int) -> DataFrame:
    """Rows of two kinds: documents (``docs``: ids, whether they have one,
    held out, numbers of words, the chunk's word numbers), and the chunk's
    distinct words of one block with their training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, size = TaskContext.get().partitionId(), 0, 0
        table, counts, ended = Numbers(), np.zeros(0, np.int64), 0
        for batch in batches:
            held = batch.column("held").to_numpy(zero_copy_only=False)
            ids = []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                ids.append(np.fromiter(map(table.__getitem__, words), dtype=np.uint32, count=len(words)))
                size += len(text or "")
            learned = [x for x, h in zip(ids, held) if not h]
            counts = np.concatenate([counts, np.zeros(len(table) - len(counts), np.int64)])
            if learned:
                counts += np.bincount(np.concatenate(learned), minlength=len(table))
            ended += len(learned)
            if ids:
                doc_id = batch.column("doc_id")
                yield _rows(task << 32 | number, docs=[packed(
                    doc_id.fill_null(0).to_numpy(), doc_id.is_valid().to_numpy(zero_copy_only=False), held,
                    np.array([len(x) for x in ids], np.uint32), np.concatenate(ids))])
            if size >= CHUNK_BYTES:
                yield _word_rows(task << 32 | number, table, counts, ended, blocks)
                number, size = number + 1, 0
                table, counts, ended = Numbers(), np.zeros(0, np.int64), 0
        if size or len(table) or ended or not number:
            yield _word_rows(task << 32 | number, table, counts, ended, blocks)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held"))
    return rows.mapInArrow(run, _CHUNKS)


def _rows(chunk: int, **columns: list) -> pa.RecordBatch:
    """Rows of one chunk; columns that aren't given are null."""
    count = len(next(iter(columns.values())))
    columns["chunk"] = [chunk] * count
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(count, t) for c, t in _ARROW.items()], names=list(_ARROW))


def _block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    return (_mix(h) % np.uint64(blocks)).astype(np.uint16)


def _word_rows(chunk: int, table: Numbers, counts: np.ndarray, ended: int, blocks: int) -> pa.RecordBatch:
    """The chunk's words by block; the end counts as the word after the last."""
    words, size = list(table), len(table) + 1
    h = np.fromiter([*map(word_hash, words), END], np.uint64, size)
    shapes, counts = np.fromiter([*map(shape, words), 0], np.uint8, size), np.append(counts, ended).astype(np.uint64)
    block = _block_of(h, blocks)
    order = np.argsort(block, kind="stable")
    begins = np.searchsorted(block[order], np.arange(blocks + 1))
    some = [b for b in range(blocks) if begins[b] < begins[b + 1]]
    parts = [order[begins[b]:begins[b + 1]] for b in some]
    return _rows(chunk, block=some, h=[h[x].tobytes() for x in parts], number=[packed(np.diff(x, prepend=0).astype(np.uint32)) for x in parts],
                 shape=[packed(shapes[x]) for x in parts], n=[packed(counts[x]) for x in parts])


# -- words -----------------------------------------------------------------

_TOTALS = "chunk long, block int, c binary, h long, shape int, n long, once long, known long"


def _totals(rows: DataFrame) -> DataFrame:
    """Training counts over all chunks (``c``) for each chunk's words of a
    block. Beside them, of each block: the end's count, its most frequent
    words, and by shape how many training tokens its words have, how many
    of them occur once, and how many words that are."""
    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(x, np.uint64) for x in pdf["h"]]
        shapes, n = (np.concatenate([unpacked(x, t)[0] for x in pdf[c]]) for c, t in (("shape", np.uint8), ("n", np.uint64)))
        h, first, place = np.unique(np.concatenate(lists), return_index=True, return_inverse=True)
        c = np.bincount(place, weights=n).astype(np.uint64)
        ends = np.cumsum([0] + [len(x) for x in lists])
        back = pd.DataFrame({"chunk": pdf["chunk"], "c": [packed(c[place[a:b]]) for a, b in zip(ends, ends[1:])],
                             "h": 0, "shape": 0, "n": 0, "once": 0, "known": 0})
        s, end = shapes[first], h == np.uint64(END)
        known = (c > 0) & ~end
        by_shape = [np.bincount(s[known], weights=w, minlength=SHAPES).astype(np.int64) for w in (c[known], c[known] == 1, np.ones(known.sum()))]
        sums = pd.DataFrame({"h": 0, "shape": np.arange(SHAPES), "n": by_shape[0], "once": by_shape[1], "known": by_shape[2]})
        signed = h.view(np.int64)
        top = np.flatnonzero(known)
        top = np.concatenate([top[np.lexsort((signed[top], -c[top].astype(np.int64)))][:HEAD], np.flatnonzero(end)])
        words = pd.DataFrame({"h": signed[top], "shape": s[top].astype(np.int64), "n": c[top].astype(np.int64), "once": 0, "known": 0})
        return pd.concat([back, sums, words]).assign(block=pdf["block"].iloc[0])[_TOTALS.replace(",", "").split()[::2]]

    return rows.filter("block is not null").select("chunk", "block", "h", "shape", "n").groupBy("block").applyInPandas(meet, _TOTALS)


# -- pairs of neighbouring words -------------------------------------------


def pair_places(flat: np.ndarray, lengths: np.ndarray, many: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the words of documents (numbers ``flat``, ``lengths`` a document)
    those whose share the pairs must tell: the word before has ``many``
    tokens (the start counts as the word after the last), and the word has
    no class of its ``own``. A flag a word, and for each flagged one a number for
    it and the word before it."""
    size = len(own)
    before = np.concatenate([np.zeros(1, np.uint64), flat[:-1].astype(np.uint64)])[:len(flat)]
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = size
    told = many[before] & ~own[flat]
    return told, before[told] * np.uint64(size + 1) + flat[told]


def _split(pairs: np.ndarray, h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of a chunk's sorted distinct pairs by block; in that order the
    numbers of both words; where each block begins. ``h``: hashes of the
    chunk's words and, last, of the start."""
    before, word = np.divmod(pairs, np.uint64(len(h)))
    block = _block_of(h, blocks)[before]
    order = np.argsort(block, kind="stable")
    return order, before[order], word[order], np.searchsorted(block[order], np.arange(blocks + 1))


class Chunk:
    """Documents and words of a chunk: ``left`` has its rows of ``_chunks``,
    ``totals`` the training counts of its words."""

    def __init__(self, left: pd.DataFrame, totals: pd.DataFrame, head: dict[int, int]):
        docs = [unpacked(x, *_DOCS) for x in left["docs"] if x is not None]
        self.doc_id, self.has_id, self.held, self.lengths, self.flat = (
            np.concatenate([*x, np.zeros(0, t)]) for x, t in zip(zip(*docs) if docs else [()] * len(_DOCS), _DOCS, strict=True))
        self.lengths = self.lengths.astype(np.int64)
        words, totals = left[left["block"].notna()].sort_values("block"), totals.sort_values("block")
        number = np.concatenate([np.cumsum(unpacked(x, np.uint32)[0], dtype=np.int64) for x in words["number"]])
        self.h, self.shape, self.c = np.empty(len(number), np.uint64), np.empty(len(number), np.int64), np.empty(len(number), np.int64)
        self.h[number] = np.concatenate([np.frombuffer(x, np.uint64) for x in words["h"]])
        self.shape[number] = np.concatenate([unpacked(x, np.uint8)[0] for x in words["shape"]])
        self.c[number] = np.concatenate([unpacked(x, np.uint64)[0] for x in totals["c"]])
        self.end = len(number) - 1
        self.kind = 1 + HEAD + self.shape
        for key, place in head.items():
            self.kind[self.h == np.uint64(key)] = place
        self.told, places = pair_places(self.flat, self.lengths, np.append(self.c[:-1] > 1, True), self.kind[:-1] <= HEAD)
        self.pairs, self.place = np.unique(places, return_inverse=True)

    def split(self, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return _split(self.pairs, np.append(self.h[:-1], np.uint64(BEFORE)), blocks)


def pair_key(h: np.ndarray, s: np.ndarray) -> np.ndarray:
    """48 bits of a following word: 43 of its hash and five of its shape."""
    return h >> np.uint64(21) << np.uint64(5) | s.astype(np.uint64)


def _pair_rows(key: tuple, chunk: Chunk, blocks: int) -> pd.DataFrame:
    """The chunk's distinct pairs with their training counts, one row for
    each block: hashes of the previous words, how many pairs each has, the
    keys of the following words and the counts."""
    h, keys = np.append(chunk.h[:-1], np.uint64(BEFORE)), pair_key(chunk.h, chunk.shape)
    learned = np.repeat(~chunk.held, chunk.lengths)[chunk.told]
    counts = np.bincount(chunk.place[learned], minlength=len(chunk.pairs)).astype(np.uint32)
    order, before, word, begins = chunk.split(blocks)
    counts, some, out = counts[order], np.flatnonzero(np.diff(begins)), []
    for b in some:
        part = slice(begins[b], begins[b + 1])
        first = np.flatnonzero(np.diff(before[part].astype(np.int64), prepend=-1))
        lengths = np.diff(first, append=begins[b + 1] - begins[b]).astype(np.uint32)
        follow = np.ascontiguousarray(keys[word[part]].view(np.uint16).reshape(-1, 4)[:, :3])
        out.append(b"".join([np.uint32(len(first)).tobytes(), h[before[part][first]].tobytes(), np.uint32(len(follow)).tobytes(),
                             follow.tobytes(), packed(lengths, counts[part])]))
    return pd.DataFrame({"chunk": key[0], "block": some.astype(np.int32), "pairs": out})


def _unpacked(value: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Previous word's hash and number, following word's key and count of
    each pair."""
    n = int(np.frombuffer(value, np.uint32, 1)[0])
    total, at = int(np.frombuffer(value, np.uint32, 1, 4 + 8 * n)[0]), 8 + 8 * n
    keys = np.zeros((total, 4), np.uint16)
    keys[:, :3] = np.frombuffer(value, np.uint16, 3 * total, at).reshape(-1, 3)
    lengths, counts = unpacked(value[at + 6 * total:], np.uint32, np.uint32)
    return np.repeat(np.frombuffer(value, np.uint64, n, 4), lengths), np.repeat(np.arange(n), lengths), keys.view(np.uint64).ravel(), counts


def _counted(before: np.ndarray, key: np.ndarray, n: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each listed pair: its count over the whole list, and of all pairs
    with the same previous word and the same class how many tokens they
    have, and how many occur once."""
    _, first, pair = np.unique(_mix(before) ^ _mix(key + np.uint64(1)), return_index=True, return_inverse=True)
    count = np.bincount(pair, weights=np.where(np.isin(key, head), 0, n))
    group = _mix(_mix(before) + (key[first][pair] & np.uint64(31)))
    _, group = np.unique(group, return_inverse=True)
    total = np.bincount(group[first], weights=count)
    once = np.bincount(group[first], weights=count == 1)
    return count[pair], total[group], once[group]


def _shares(count: np.ndarray, total: np.ndarray, once: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left = (once + 2.0) / (total + 2.0)
    share = count / np.maximum(total, 1.0) * (1.0 - left)
    return share.astype(np.float32), left.astype(np.float32)


def followers(before: np.ndarray, key: np.ndarray, n: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each listed pair, by the counts of all that are listed: the share
    that the previous word gives to the following one among its class, and
    the share that it leaves to what is known without it. Followers met
    once (Good-Turing) are left; a previous word after which nothing recurs
    leaves all. ``head``: keys of the words with a class of their own."""
    return _shares(*_counted(before, key, n, head))


def _followers(pairs: DataFrame) -> DataFrame:
    """``chunk, block, c``: the counts that make the shares of a chunk's
    pairs of a block, those of a group (previous word and class) once."""
    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [_unpacked(x) for x in pdf["pairs"]]
        before, key, n = (np.concatenate([x[k] for x in lists]) for k in (0, 2, 3))
        counted = [x.astype(np.uint64) for x in _counted(before, key, n, np.zeros(0, np.uint64))]
        ends, found = np.cumsum([0] + [len(x[0]) for x in lists]), []
        for (_, place, own, _), a, b in zip(lists, ends, ends[1:], strict=False):
            count, total, once = (x[a:b] for x in counted)
            _, first = np.unique(place.astype(np.int64) << 5 | (own & np.uint64(31)).astype(np.int64), return_index=True)
            found.append(packed(count, total[first], once[first]))
        return pd.DataFrame({"chunk": pdf["chunk"], "block": pdf["block"], "c": found})

    return pairs.groupBy("block").applyInPandas(meet, "chunk long, block int, c binary")


def _told(chunk: Chunk, found: pd.DataFrame, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Both shares of each word of the chunk's documents."""
    order, before, word, begins = chunk.split(blocks)
    own, rest = np.empty(len(order), np.float32), np.empty(len(order), np.float32)
    group = before.astype(np.int64) << 5 | chunk.shape[word]
    for block, value in zip(found["block"], found["c"], strict=True):
        count, total, once = (x.astype(np.float64) for x in unpacked(value, *[np.uint64] * 3))
        part = slice(begins[block], begins[block + 1])
        _, of = np.unique(group[part], return_inverse=True)
        own[order[part]], rest[order[part]] = _shares(count, total[of], once[of])
    share, left = np.zeros(len(chunk.flat), np.float32), np.ones(len(chunk.flat), np.float32)
    share[chunk.told], left[chunk.told] = own[chunk.place], rest[chunk.place]
    return share, left


# -- training and scoring --------------------------------------------------


def _train(docs: DataFrame, bias: np.ndarray, head: dict[int, int], tasks: int, bits: int) -> np.ndarray:
    """Weights after one pass of gradient steps over all training texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, words = ClassModel(bias, bits=bits), Words(head)
        squares, met = np.full((1 << bits, CLASSES), 1.0, np.float32), np.zeros(1 << bits, np.int64)
        for pdf in batches:
            low = np.uint64(63)
            coded = [words.code(words_of(t)) for t in pdf["text"]]
            if not coded:
                continue
            flat, at = sequence(coded)
            y = (flat & low).astype(np.int64)
            y[flat == END] = 0
            model.steps(features(flat & ~low | np.where(flat < 64, flat, 0), bits)[:, at], y[at + 2], squares, met)
        for b in range(0, 1 << bits, BLOCK_ROWS):
            part = slice(b, b + BLOCK_ROWS)
            if met[part].any():
                yield pd.DataFrame({"block": [b // BLOCK_ROWS], "weights": [model.weights[part].tobytes()], "met": [met[part].tobytes()]})

    def average(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, list] = {}
        for pdf in batches:
            for b, w, m in zip(pdf["block"], pdf["weights"], pdf["met"]):
                met = np.frombuffer(m, np.int64)
                own = sums.setdefault(b, [np.zeros((BLOCK_ROWS, CLASSES)), np.zeros(BLOCK_ROWS, np.int64)])
                own[0] += np.frombuffer(w, np.float32).reshape(-1, CLASSES) * met[:, None]
                own[1] += met
        for b, (w, met) in sums.items():
            yield pd.DataFrame({"block": [b], "weights": [(w / np.maximum(met, 1)[:, None]).astype(np.float32).tobytes()]})

    texts = docs.filter(~held_out(F.col("doc_id"))).select("text").coalesce(tasks)
    updates = texts.mapInPandas(run, "block int, weights binary, met binary")
    mean = updates.repartition(ROWS // BLOCK_ROWS, "block").mapInPandas(average, "block int, weights binary")
    weights = np.zeros((1 << bits, CLASSES), np.float32)
    for row in mean.toLocalIterator():  # the weight table: 4 MB, 256 bytes a row of a larger one
        a = row["block"] * BLOCK_ROWS
        weights[a:a + BLOCK_ROWS] = np.frombuffer(row["weights"], np.float32).reshape(-1, CLASSES)
    return weights


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` per row of ``docs``.

    A null or empty text is its end alone. Repeated rows count and are
    scored each; rows without doc_id are held out. If no row is left to
    learn from, nothing is known: both scores follow from the smoothing
    alone. Other columns are ignored; an empty table gives an empty
    result."""
    small_batches(docs.sparkSession)
    size = text_bytes(docs)
    blocks = min(1 << 16, parts_for(size, PAIR_BYTES, 8))
    rows = written(_chunks(docs, blocks), "lm-chunks")
    totals = written(_totals(rows), "lm-words")
    by_block = totals.filter("chunk is null")
    top = by_block.filter(~F.col("h").isin(0, END)).orderBy(F.desc("n"), "h").limit(HEAD).select("h", F.col("n").alias("c"), "shape").collect()
    head = {r["h"] & (1 << 64) - 1: i for i, r in enumerate(top, 1)} | {END: 0}
    ends = by_block.filter(F.col("h") == END).agg(F.sum("n")).first()[0] or 0
    by_shape = by_block.filter("h = 0").groupBy("shape").agg(F.sum("n").alias("n"), F.sum("once").alias("once"), F.sum("known").alias("known")).collect()
    total, distinct = int(ends + sum(r["n"] for r in by_shape)), int((ends > 0) + sum(r["known"] for r in by_shape))
    n, once = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in by_shape:
        n[r["shape"]], once[r["shape"]] = r["n"], r["once"]
    for r in top:  # these have classes of their own
        n[r["shape"]] -= r["c"]
        once[r["shape"]] -= r["c"] == 1
    unseen = np.where(n > 0, (once + 1.0) / (n + 2.0), 1.0)
    mass = np.concatenate([[ends], [r["c"] for r in top], np.zeros(HEAD - len(top)), n])
    bias = np.log((mass + 0.5) / (mass + 0.5).sum())
    parallel = docs.sparkSession.sparkContext.defaultParallelism
    weights = _train(docs, bias, head, parts_for(size, TRAIN_BYTES, 2 * parallel), row_bits(total)) if total else None
    return _scored(rows, totals.filter("chunk is not null").select("chunk", "block", "c"), blocks, ClassModel(bias, weights), head, n, unseen, total, distinct)


def _scored(rows: DataFrame, totals: DataFrame, blocks: int, model: ClassModel, head: dict[int, int], n: np.ndarray, unseen: np.ndarray,
            total: int, distinct: int) -> DataFrame:
    session = rows.sparkSession
    shared = session.sparkContext.broadcast(model.weights)  # every text meets rows all over the table
    bias, norm = model.bias, total + 0.1 * (distinct + 1)

    def pairs(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _pair_rows(key, Chunk(left, right, head), blocks)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        net, chunk = ClassModel(bias, shared.value), Chunk(left, right[~right["pair"]], head)
        share, rest = _told(chunk, right[right["pair"]], blocks)
        h, c, s, kind, end = chunk.h, chunk.c.astype(np.float64), chunk.shape, chunk.kind, chunk.end
        inside = np.where(c > 0, (1.0 - unseen[s]) * c / np.maximum(n[s], 1.0), unseen[s])
        base = np.log10((c + 0.1) / norm)
        at_word, out = np.cumsum(chunk.lengths) - chunk.lengths, []
        for a in range(0, len(chunk.lengths), 256):
            lengths = chunk.lengths[a:a + 256]
            words = slice(at_word[a], at_word[a] + lengths.sum())
            coded = np.split(chunk.flat[words], np.cumsum(lengths)[:-1])
            flat, at = sequence([h[x] for x in coded])
            place = np.concatenate([y for x in coded for y in (x, [end])]).astype(np.int64)
            chance, is_word = inside[place], place != end
            chance[is_word] = share[words] + rest[words] * chance[is_word]
            chance = np.where(kind[place] > HEAD, np.log10(np.maximum(chance, 1e-300)), 0.0)
            value = net.log10(features(flat, net.bits)[:, at], kind[place]) + chance
            starts = np.cumsum(lengths + 1) - lengths - 1
            out.append(pd.DataFrame({
                "doc_id": pd.arrays.IntegerArray(chunk.doc_id[a:a + 256], ~chunk.has_id[a:a + 256]), "held_out": chunk.held[a:a + 256],
                "n_tokens": lengths + 1, "n_known": np.add.reduceat((c[place] > 0).astype(np.int64), starts), "train_tokens": total,
                "base_score": np.add.reduceat(base[place], starts), "score": np.add.reduceat(value, starts)}))
        return pd.concat(out) if out else pd.DataFrame(columns=_RESULT)

    # Both passes read one shuffle of the chunks.
    chunks = rows.select("chunk", "docs", "block", "h", "number", "shape").groupBy("chunk")
    found = _followers(chunks.cogroup(totals.groupBy("chunk")).applyInPandas(pairs, "chunk long, block int, pairs binary"))
    counts = totals.withColumn("pair", F.lit(False)).unionByName(found.withColumn("pair", F.lit(True)))
    return chunks.cogroup(counts.groupBy("chunk")).applyInPandas(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


_RESULT = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
