"""Best-fit packing of tokenised documents with swap-based local search.

Documents are tokenised, closed with an end id and cut into pieces of at
most ``CAPACITY`` tokens. Pieces are dealt into groups by hash; within a
group best-fit decreasing fills bins, and a local search on the underfull
ones moves pieces, exchanges one for one or two for one as long as the sum
of squared fills grows, until bins run empty. Full bins are final. The
pieces of underfull bins go on to a next round with fewer groups, until
one bounded group is left or a round no longer shrinks the leftovers.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortlens.llm.common import small_batches, written

CAPACITY = 4096
END_ID = 1
#: Pieces that one task packs at a time.
GROUP = 20_000
#: A bin filled to this share is final.
FULL = 0.995
#: Bins that the local search offers a piece to before it gives up.
TRIES = 64
MAX_WORDS = 600_000


# A letter or digit next to ASCII punctuation other than the
# apostrophe. The tokenizer always splits there.
_EDGE = re.compile(rb"(?<=[A-Za-z0-9])(?=[!-&(-/:-@\[-`{-~])|(?<=[!-&(-/:-@\[-`{-~])(?=[A-Za-z0-9])")


_PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Pending(dict):
    """Ids by word; an unknown word gets a place that is filled later."""

    def __init__(self):
        self.places: dict[bytes, bytearray] = {}

    def __missing__(self, word: bytes) -> bytearray:
        return self.places.setdefault(word, bytearray())


class WordEncoder:
    """Ids of texts by a tokenizer that lower-cases, drops white space and
    never joins across it or across the edge of a run of letters: each
    distinct word, and of new words each distinct part between such edges,
    is encoded once and its ids are kept as little-endian 32-bit bytes, up
    to ``MAX_WORDS`` words. Parts of letters or punctuation alone are
    encoded many at a time, as each of them ends with one of the tokens that
    end a word. Texts with a special token's string go to the library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a worker for each core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        apart, joined = ([i for t in x for i in self._ids(t)] for x in (["One", "é", "1", "'s", "..."], ["One é1\t's\n ..."]))
        if apart != joined:
            raise ValueError("this tokenizer joins across white space")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = Pending()
        self.parts: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode_parts(self, parts: list[bytes]) -> None:
        blocks = [parts[a:a + 256] for a in range(0, len(parts), 256)]
        texts = [b" ".join(block).decode("utf-8", "surrogatepass") for block in blocks]
        for block, encoded in zip(blocks, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(encoded.ids, dtype="<u4")
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(stops) == len(block):
                data, starts = ids.tobytes(), [0, *stops[:-1]]
                self.parts.update(zip(block, [data[x:y] for x, y in zip(starts, stops)]))
            else:  # some part is more than one word to the tokenizer
                self._encode_singly(block)

    def _encode_singly(self, parts: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([x.decode("utf-8", "surrogatepass") for x in parts], add_special_tokens=False)
        self.parts.update(zip(parts, [array("I", e.ids).tobytes() for e in found]))

    def _learn(self, new: list[bytes]) -> None:
        parts = [[w] if w.isalpha() else _EDGE.sub(b" ", w).split() for w in new]
        unknown = [x for x in set().union(*parts) if x not in self.parts]
        plain = lambda x: not x.strip(_PUNCTUATION) if x.isascii() else x.decode("utf-8", "surrogatepass").isalpha()
        simple, others = [], []
        for x in unknown:
            (simple if x.isalpha() or plain(x) else others).append(x)
        self._encode_parts(simple)
        if others:
            self._encode_singly(others)
        at = self.parts.__getitem__
        self.words.update(zip(new, [at(x[0]) if len(x) == 1 else b"".join(map(at, x)) for x in parts]))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text (null or empty: none)."""
        if len(self.words) > MAX_WORDS:
            self.words, self.parts = Pending(), {}
        look, found = self.words.__getitem__, []
        for text in texts:
            data = text.encode("utf-8", "surrogatepass") if text else b""
            if any(s in data for s in self.special):
                found.append([array("I", self._ids(text)).tobytes()])
                continue
            # A letter and U+0300 to U+036F may compose differently in lower case.
            if b"\xcc" not in data and b"\xcd" not in data:
                data = data.lower()
            found.append(list(map(look, data.split())))
        places, self.words.places = self.words.places, {}
        self._learn(list(places))
        for word, place in places.items():
            place[:] = self.words[word]
        return [b"".join(ids) for ids in found]


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids`` as binary
    little-endian 32-bit) for every piece of every document. A null text is
    empty: its one piece is the end id."""
    small_batches(docs.sparkSession)
    schema = "array<struct<start:bigint,length:bigint,ids_crc32:bigint" + (",ids:binary" if with_ids else "") + ">>"
    end, width = end_id.to_bytes(4, "little"), 4 * capacity

    @F.pandas_udf(schema)
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(tokenizer_path)
        for texts in batches:
            out = []
            for ids in encoder.encode(texts.tolist()):
                ids += end
                out.append([{"start": n // 4, "length": len(p) // 4, "ids_crc32": zlib.crc32(p)} | ({"ids": p} if with_ids else {})
                            for n in range(0, len(ids), width) for p in (ids[n:n + width],)])
            yield pd.Series(out, dtype=object)

    return (docs.select("doc_id", F.posexplode(cut(F.col("text"))).alias("piece", "p"))
            .select("doc_id", "piece", "p.*"))


# -- one group ----------------------------------------------------------


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece goes to the fullest bin that it
    fits. Bins are lists of positions in ``lengths``."""
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect_left(rooms, lengths[i])
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
            bins[b].append(i)
        else:
            b, room = len(bins), capacity
            bins.append([i])
        left = room - lengths[i]
        if left:
            if left not in by_room:
                insort(rooms, left)
                by_room[left] = []
            by_room[left].append(b)
    return bins


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, full: int, tries: int = TRIES) -> list[list[int]]:
    """Moves, one-for-one and two-for-one exchanges between underfull bins
    (less than ``full`` tokens).

    The emptiest bin gives: one of the ``tries`` fullest others takes a
    piece that fits its room, or trades one of its pieces for a larger one
    or for two whose surplus fits. Each step moves tokens from an emptier
    to a fuller bin, so the sum of squared fills grows and the search ends.
    A bin that runs empty is gone; one that can give no more is kept."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    open_bins = sorted((f, n) for n, f in enumerate(fill) if f < full)
    while len(open_bins) > 1:
        _, g = open_bins.pop(0)
        stepped = True
        while stepped and bins[g]:
            stepped = False
            for f, t in open_bins[:-tries - 1:-1]:
                step = _best_step(bins[g], bins[t], lengths, capacity - f) if f >= fill[g] else None
                if not step:
                    continue
                gained, out, back = step
                bins[t] = [i for i in bins[t] if i not in back] + out
                bins[g] = [i for i in bins[g] if i not in out] + back
                open_bins.remove((f, t))
                fill[g] -= gained
                fill[t] += gained
                if fill[t] < full:
                    insort(open_bins, (fill[t], t))
                stepped = True
                break
    return [b for b in bins if b]


def _best_step(giver: list[int], taker: list[int], lengths: list[int], room: int) -> tuple[int, list[int], list[int]] | None:
    """The exchange that moves most tokens, at most ``room``. Pieces of one
    length are alike, and few lengths fit into one bin."""
    if not room:
        return None
    same: dict[int, list[int]] = {}
    for i in giver:
        same.setdefault(lengths[i], []).append(i)
    own = sorted((lengths[i], i) for i in taker)
    sizes = [n for n, _ in own]
    kinds = sorted(same)
    best: tuple[int, list[int], list[int]] | None = None
    for n in kinds:
        if n <= room and (best is None or n > best[0]):
            best = n, same[n][:1], []
    outs = [(n, same[n][:1]) for n in kinds]
    outs += [(n + m, same[n][:1] + same[m][:1]) for k, n in enumerate(kinds) for m in kinds[k + 1:]]
    outs += [(2 * n, same[n][:2]) for n in kinds if len(same[n]) > 1]
    for size, out in outs:
        at = bisect_left(sizes, size - room)  # the smallest piece back after which it fits
        if at < len(own) and size > sizes[at] and (best is None or size - sizes[at] > best[0]):
            best = size - sizes[at], out, [own[at][1]]
            if best[0] == room:
                break
    return best


def _pack_group(pdf: pd.DataFrame, capacity: int) -> pd.DataFrame:
    lengths = pdf["length"].tolist()
    bins = local_search(best_fit(lengths, capacity), lengths, capacity, int(capacity * FULL))
    sequence, offset, filled = [0] * len(lengths), [0] * len(lengths), [0] * len(lengths)
    for number, b in enumerate(bins):
        at = 0
        for i in b:
            sequence[i], offset[i] = number, at
            at += lengths[i]
        for i in b:
            filled[i] = at
    return pdf.assign(sequence_id=sequence, offset=offset, filled=filled)


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to each row of ``pieces``.

    Each round writes its table, so that no later one packs again. Groups
    hold about ``group`` pieces and are dealt by a hash of the piece, with
    repeated rows spread by their place in the table."""
    rows = pieces.withColumn("deal", F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()))
    rows = written(rows, "pack-pieces")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    names, results, level, full = rows.columns, [], 0, int(capacity * FULL)
    left = rows.count()
    while left:
        groups = -(-left // group)
        dealt = rows.withColumn("deal", F.xxhash64("deal", F.lit(level))).withColumn("g", F.pmod("deal", F.lit(groups)))
        packed = written(
            dealt.groupBy("g").applyInPandas(
                lambda pdf: _pack_group(pdf, capacity), f"{schema}, g bigint, sequence_id bigint, offset bigint, filled bigint")
            .withColumn("sequence_id", F.lit(level << 56) + F.shiftleft(F.col("g"), 24) + F.col("sequence_id")), "pack-round")
        under = packed.filter(F.col("filled") < full)
        after = under.count()
        last = groups == 1 or after >= left * 0.9
        results.append(packed if last else packed.filter(F.col("filled") >= full))
        if last:
            break
        rows, left, level = under.select(names), after, level + 1
    if not results:
        return rows.select(*pieces.columns, F.lit(0).cast("bigint").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Every row of ``docs`` is packed, repeated rows and null doc_ids too; a
    null or empty text is one piece with only the end id. Only documents
    longer than ``capacity`` are cut. Other columns are ignored; an empty
    table gives an empty result."""
    return pack(token_pieces(docs, tokenizer_path, capacity, end_id), capacity)
