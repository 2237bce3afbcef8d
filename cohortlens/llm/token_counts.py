"""Token counts by a compiled finite-state transducer.

A byte-level BPE tokenizer is compiled, while texts are read, into one
deterministic transducer over characters. A state holds

* where the pre-token split stands (inside a letter, number or other run,
  in white space whose last character may join the next word, after an
  apostrophe that may open a contraction), and
* the *live* part of the BPE encoding: for every start that a vocabulary
  entry could still span, the entry's bytes so far, the last token of the
  prefix before it and that prefix's token count relative to now.

A token sequence is the BPE encoding of its bytes exactly when every
adjacent pair of tokens encodes to itself, so the last token of each
prefix follows from the live part alone, and a transition's weight is the
change of the token count. Weights can be negative: a merge of two tokens
lowers the count. Each transition is derived once and then looked up.

A text is cut into chunks of a fixed width. A chunk's state map is
``(head, weight, tail)``: between a non-space and a white space character
every state behaves alike, so after the first such place in the chunk the
map no longer depends on the entering state. ``weight`` counts what lies
between the first and the last of these places, ``tail`` is the state at
the chunk's end and ``head`` the text before the first, which the entering
state still has to read. Maps compose associatively; a document's count is
the pairwise (parallel prefix) composition of its chunks' maps.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import small_batches

# The Unicode White_Space characters.
SPACES = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE = re.compile(f"[{SPACES}]")
_SYNC = re.compile(f"(?<=[^{SPACES}])(?=[{SPACES}])")
_PIECES = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
_LETTER, _NUMBER = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")

# Pre-token split modes.
START, LETTERS, NUMBERS, OTHERS, SPACE, APOSTROPHE, HALF, DONE = range(8)
# Contractions "'s 't 'm 'd" and the first letters of "'re 've 'll".
_SHORT, _LONG = "stmd", {"r": "e", "v": "e", "l": "l"}

CHUNK_CHARS = 1 << 14
MAX_STATES = 200_000
MAX_PIECES = 800_000


def _byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: the
    byte itself where it is printable, else the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in shown}
    hidden = (b for b in range(256) if chr(b) not in table)
    return table | {chr(256 + n): b for n, b in enumerate(list(hidden))}


class ByteBpe:
    """Vocabulary trie and merge trees of a byte-level BPE tokenizer file.

    Merge ranks grow from parts to whole, so encoding applies the merges in
    rank order, and two neighbouring tokens stay apart unless some merge of
    an edge part of the left one with an edge part of the right one comes
    before the merges that absorb these parts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte, vocab = _byte_alphabet(), spec["model"]["vocab"]
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.child: dict[int, int] = {}
        self.token_at = [-1]
        for piece, i in vocab.items():
            node = 0
            for c in piece:
                if (after := self.child.get(node << 8 | to_byte[c])) is None:
                    after = self.child[node << 8 | to_byte[c]] = len(self.token_at)
                    self.token_at.append(-1)
                node = after
            self.token_at[node] = i
        self.merges: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = vocab["".join(pair.split(" ") if isinstance(pair, str) else pair)]
            below = [self.parts[x][2] for x in (left, right) if x in self.parts]
            if whole in self.parts or any(r >= rank for r in below):
                raise ValueError("merges must build each token once, from earlier ones")
            self.merges[left, right] = rank
            self.parts[whole] = left, right, rank
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.whole: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(part, rank of the merge that absorbs it) along one edge."""
        if (edge := self.edges.get((token, side))) is None:
            edge, part, absorbed = [], token, 1 << 60
            while True:
                edge.append((part, absorbed))
                if part not in self.parts:
                    break
                absorbed = self.parts[part][2]
                part = self.parts[part][side]
            self.edges[token, side] = edge
        return edge

    def apart(self, left: int, right: int, before: int = 1 << 60) -> bool:
        """No merge ranked below ``before`` crosses between two tokens. Of
        equal merges the leftmost goes first."""
        for u, u_gone in self._edge(left, 1):
            for v, v_gone in self._edge(right, 0):
                rank = self.merges.get((u, v))
                if rank is not None and rank < before and rank < u_gone and rank <= v_gone:
                    return False
        return True

    def reachable(self, token: int) -> bool:
        """Encoding the token's own bytes gives the token."""
        if (found := self.whole.get(token)) is None:
            found = True
            if token in self.parts:
                left, right, rank = self.parts[token]
                found = self.reachable(left) and self.reachable(right) and self.apart(left, right, rank)
            self.whole[token] = found
        return found


#: Token counts in a live start are relative to the current one; a start is
#: packed as (trie node, last token + 1, relative count + _ZERO).
_ZERO = 1 << 11
_FRESH = (_ZERO,)


class CountTransducer:
    """Deterministic transducer whose transition weights sum to the number
    of tokens. Transitions are derived on first use; past ``MAX_STATES``
    the tables start afresh, so a worker's memory is bounded."""

    def __init__(self, path: str):
        self.bpe = ByteBpe(path)
        self.special = re.compile("|".join(map(re.escape, self.bpe.special))) if self.bpe.special else None
        self.pairs: dict[int, bool] = {}
        self.kinds: dict[str, int] = {}
        self.pieces: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        self.byte_steps: dict[tuple, tuple] = {}
        self.states: list[tuple] = []
        self.arcs: dict[int, tuple[int, int]] = {}
        self.ends: list[int] = []
        self.number: dict[tuple, int] = {}
        self.start = self._intern((START, _FRESH, ""))

    # -- BPE part: states are the live starts, labels are bytes ------------

    def _fits(self, last: int, token: int) -> bool:
        key = last << 20 | token
        if (fits := self.pairs.get(key)) is None:
            fits = self.bpe.reachable(token) and (last < 0 or self.bpe.apart(last, token))
            if len(self.pairs) > 4 * MAX_STATES:
                self.pairs.clear()
            self.pairs[key] = fits
        return fits

    def _read(self, live: tuple, data: bytes) -> tuple[tuple, int]:
        weight, child, token_at = 0, self.bpe.child, self.bpe.token_at
        for byte in data:
            if (step := self.byte_steps.get((live, byte))) is None:
                kept, token, count = [], -1, 0
                for start in live:
                    node = child.get(start >> 32 << 8 | byte)
                    if node is not None:
                        kept.append(node << 32 | start & 0xFFFFFFFF)
                        t = token_at[node]
                        if t >= 0 and token < 0 and self._fits((start >> 12 & 0xFFFFF) - 1, t):
                            token, count = t, (start & 0xFFF) - _ZERO + 1
                step = (*[s - count for s in kept], token + 1 << 12 | _ZERO), count
                self.byte_steps[live, byte] = step
            live, w = step
            weight += w
        return live, weight

    # -- pre-token part: labels are characters ------------------------------

    def _kind(self, ch: str) -> int:
        if (kind := self.kinds.get(ch)) is None:
            kind = SPACE if _SPACE.match(ch) else LETTERS if _LETTER.match(ch) else \
                NUMBERS if _NUMBER.match(ch) else APOSTROPHE if ch == "'" else OTHERS
            self.kinds[ch] = kind
        return kind

    def _begin(self, ch: str) -> tuple[tuple, int]:
        kind = self._kind(ch)
        if kind == SPACE:
            return (SPACE, _FRESH, ch), 0
        live, w = self._read(_FRESH, ch.encode())
        return (kind, live, ""), w

    def _next(self, state: tuple, ch: str) -> tuple[tuple, int]:
        mode, live, held = state
        kind = self._kind(ch)
        same = mode == kind and mode in (LETTERS, NUMBERS) or mode in (OTHERS, APOSTROPHE) and kind in (OTHERS, APOSTROPHE)
        if same:
            live, w = self._read(live, ch.encode())
            return (mode if mode != APOSTROPHE else OTHERS, live, ""), w
        if mode == APOSTROPHE and ch in _SHORT:
            live, w = self._read(live, ch.encode())
            return (DONE, live, ""), w
        if mode == APOSTROPHE and ch in _LONG:
            return (HALF, live, ch), 0
        if mode == HALF:
            if _LONG[held] == ch:
                live, w = self._read(live, (held + ch).encode())
                return (DONE, live, ""), w
            alone, w = self._begin(held)
            after, v = self._next(alone, ch)
            return after, w + v
        if mode == SPACE:
            if kind == SPACE:
                live, w = self._read(live, held.encode())
                return (SPACE, live, ch), w
            live, w = self._read(_FRESH, held.encode())
            if held == " ":
                live, v = self._read(live, ch.encode())
                return (OTHERS if kind == APOSTROPHE else kind, live, ""), w + v
            after, v = self._begin(ch)
            return after, w + v
        return self._begin(ch)

    def _intern(self, state: tuple) -> int:
        if (n := self.number.get(state)) is None:
            n = self.number[state] = len(self.states)
            mode, live, held = state
            self.states.append(state)
            self.ends.append(self._read(live, held.encode())[1] if mode == SPACE else
                             self._begin(held)[1] if mode == HALF else 0)
        return n

    def run(self, state: int, text: str) -> tuple[int, int]:
        """(state after, weight) of reading ``text`` from ``state``."""
        weight, arcs = 0, self.arcs
        for ch in text:
            arc = arcs.get(state << 21 | ord(ch))
            if arc is None:
                after, w = self._next(self.states[state], ch)
                arc = arcs[state << 21 | ord(ch)] = self._intern(after), w
            state = arc[0]
            weight += arc[1]
        return state, weight

    # -- chunks -----------------------------------------------------------

    def _piece(self, piece: str) -> int:
        """Weight of one stretch between two places where states agree."""
        if (n := self.pieces.get(piece)) is None:
            state, n = self.run(self.start, piece)
            n += self.ends[state]
            if len(self.pieces) >= MAX_PIECES:
                self.pieces.clear()
            self.pieces[piece] = n
        return n

    def chunk_map(self, chunk: str) -> tuple[str, int, int | None]:
        first = _SYNC.search(chunk)
        if not first:
            return chunk, 0, None
        pieces = _PIECES.findall(chunk, first.start())
        tail, open_weight = self.run(self.start, pieces.pop())
        return chunk[:first.start()], sum(map(self._piece, pieces)) + open_weight, tail

    def compose(self, a: tuple, b: tuple) -> tuple[str, int, int | None]:
        if a[2] is None:
            return a[0] + b[0], a[1] + b[1], b[2]
        state, w = self.run(a[2], b[0])
        if b[2] is None:
            return a[0], a[1] + w, state
        return a[0], a[1] + w + self.ends[state] + b[1], b[2]

    def count(self, text: str | None, chunk_chars: int = CHUNK_CHARS) -> int:
        if not text:
            return 0
        if len(self.states) > MAX_STATES or len(self.byte_steps) > 2 * MAX_STATES:
            self._reset()
        spans = self.special.split(text) if self.special else [text]
        total = len(spans) - 1
        for span in spans:
            maps = [("", 0, self.start)] + [self.chunk_map(span[n:n + chunk_chars])
                                            for n in range(0, len(span), chunk_chars)]
            while len(maps) > 1:
                maps = [self.compose(*maps[n:n + 2]) if n + 1 < len(maps) else maps[n]
                        for n in range(0, len(maps), 2)]
            total += maps[0][1] + self.ends[maps[0][2]]
        return total


@lru_cache(maxsize=2)
def _transducer(path: str) -> CountTransducer:
    return CountTransducer(path)


def token_count(text: Column, tokenizer_path: str) -> Column:
    """Tokens of each text (null or empty: 0)."""
    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = _transducer(tokenizer_path)
        for texts in batches:
            yield pd.Series([machine.count(t) for t in texts], dtype="int64")
    return counted(text)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``.

    A null text counts as empty (0 bytes, 0 tokens); equal rows give equal
    result rows; columns other than doc_id and text are ignored; an empty
    table gives an empty result. Narrow: no shuffle, one pass."""
    small_batches(docs.sparkSession)
    return (docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                        token_count(F.col("text"), tokenizer_path).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
