"""SentencePiece encoding and decoding through a distinct-chunk table.

A text is normalised by marking every space with U+2581 and one more mark
in front. When no piece of the model holds a mark after another character,
no merge crosses from a character to the next mark: every *marked word*
(its marks and the characters up to the next mark) has ids of its own.
Each distinct marked word of a batch is segmented once by the library; a
text's ids are its words' ids joined by position. The table of words seen
lives in the Python worker and beyond ``MAX_WORDS`` keeps those in use, so memory is bounded and nothing is shuffled or broadcast.

A model with a piece that crosses a mark, another normaliser or other
symbols of its own is refused, since words would then not be independent.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import small_batches

MARK = "▁"
MAX_WORDS = 400_000
_WORDS = re.compile(f"{MARK}+[^{MARK}]*")


class Codec:
    def __init__(self, model_path: str):
        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece of this model crosses a white space mark")
        probe = "  ﬁ\t x ©  "
        if self._library([MARK + probe.replace(" ", MARK)])[0] != sp.encode(probe):
            raise ValueError("this model's normaliser does more than mark spaces")
        self.table: dict[str, bytes] = {}

    def _library(self, marked: list[str]) -> list[list[int]]:
        """Ids of marked words. The library puts one mark in front of what
        it is given, so that mark is taken off first; of a mark alone
        nothing would be left."""
        alone = self.sp.piece_to_id(MARK)
        found = self.sp.encode([w[1:] for w in marked], num_threads=1)
        return [[alone] if w == MARK else ids for w, ids in zip(marked, found)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text (null or empty: none)."""
        split = [_WORDS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        needed = set().union(*split)
        if len(self.table) > MAX_WORDS:  # words in use again stay
            self.table = {w: self.table[w] for w in needed if w in self.table}
        new = [w for w in needed if w not in self.table]
        if new:
            self.table.update(zip(new, [array("i", ids).tobytes() for ids in self._library(new)]))
        at = self.table.__getitem__
        return [np.frombuffer(b"".join(map(at, words)), dtype=np.int32) for words in split]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return [self.sp.decode(x.tolist()) if len(x) else "" for x in ids]


@lru_cache(maxsize=2)
def _codec(model_path: str) -> Codec:
    return Codec(model_path)


def encode(text: Column, model_path: str) -> Column:
    """Ids of each text as ``array<int>`` (null or empty: an empty array)."""
    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(model_path)
        for texts in batches:
            yield pd.Series(codec.encode(texts.tolist()), dtype=object)
    return encoded(text)


def decode(ids: Column, model_path: str) -> Column:
    """Text of each id array (null or empty: the empty text)."""
    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(model_path)
        for arrays in batches:
            yield pd.Series(codec.decode([() if x is None else x for x in arrays]), dtype=object)
    return decoded(ids)


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, ids, decoded``: ids of every text and the text that the
    library's ``decode`` makes of them, in one pass.

    A null text counts as empty: no ids, empty text. Repeated rows give
    repeated result rows; other columns are ignored; an empty table gives
    an empty result."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("ids array<int>, decoded string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(model_path)
        for texts in batches:
            ids = codec.encode(texts.tolist())
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(codec.decode(ids), dtype=object)})

    return (docs.select("doc_id", both(F.col("text")).alias("both"))
            .select("doc_id", "both.ids", "both.decoded"))
