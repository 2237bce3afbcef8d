"""Minimal acyclic transducers over sorted byte strings.

``build`` takes sorted terms and keeps one state for each distinct set of
continuations: while terms come in order, everything below the part shared
with the next one is final and is merged with an equal state if there is one.
A transition emits how many terms come before all that continue through it,
so the sum along a term's path is its rank in the order.

``Transducer`` walks many terms of a text at once: step by step all terms
that are still on a path read their next byte, with the transitions in an
open hash table of numpy arrays.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa


def build(terms: Iterable[bytes]) -> dict:
    """Transitions ``key`` (state << 8 | byte), ``target``, ``output``, the
    states' ``final`` flags and the ``root``. The terms must be sorted,
    distinct and not empty; of none, the root accepts nothing."""
    states: list[tuple] = []
    known: dict[tuple, int] = {}
    below: list[int] = []  # terms that a state accepts

    def merged(node: list) -> int:
        signature = tuple(node)
        at = known.get(signature)
        if at is None:
            at = known[signature] = len(states)
            states.append(signature)
            below.append(signature[0] + sum(below[t] for t in signature[2::2]))
        return at

    # A state is [final, byte, target, byte, target, ...].
    path: list[list] = [[0]]
    before = b""

    def close(down_to: int) -> None:
        while len(path) - 1 > down_to:
            target = merged(path.pop())
            path[-1] += (before[len(path) - 1], target)

    for term in terms:
        if term <= before:
            raise ValueError("terms must be sorted, distinct and not empty")
        shared = 0
        for a, b in zip(before, term, strict=False):
            if a != b:
                break
            shared += 1
        close(shared)
        path.extend([0] for _ in range(len(term) - shared))
        path[-1][0] = 1
        before = term
    close(0)
    root = merged(path[0])

    key, target, output = [], [], []
    for state, (final, *edges) in enumerate(states):
        passed = final
        for byte, to in zip(edges[::2], edges[1::2], strict=True):
            key.append(state << 8 | byte)
            target.append(to)
            output.append(passed)
            passed += below[to]
    return {"key": np.array(key, dtype=np.int64), "target": np.array(target, dtype=np.int64),
            "output": np.array(output, dtype=np.int64), "final": np.array([s[0] for s in states], dtype=bool), "root": root}


class Transducer:
    """Several built transducers side by side; part ``p`` starts at
    ``roots[p]`` and ranks from ``first[p]`` on."""

    def __init__(self, parts: list[dict], first: list[int]):
        sizes = [len(p["final"]) for p in parts]
        shift = np.cumsum([0, *sizes[:-1]]) if parts else np.zeros(0, dtype=np.int64)
        joined = lambda name, moved: np.concatenate([np.zeros(0, dtype=np.int64), *[p[name] + moved(s) for p, s in zip(parts, shift, strict=True)]])
        key, target, output = joined("key", lambda s: s << 8), joined("target", lambda s: s), joined("output", lambda s: 0)
        self.final = np.concatenate([np.zeros(0, dtype=bool), *[p["final"] for p in parts]])
        self.roots = np.array([p["root"] + s for p, s in zip(parts, shift, strict=True)], dtype=np.int64)
        self.first = np.array(first, dtype=np.int64)
        # Four slots for each transition: most look-ups end at the first.
        self.bits = max(4, (4 * len(key)).bit_length())
        self.mask = (1 << self.bits) - 1
        slot = np.full(1 << self.bits, -1, dtype=np.int64)
        todo, at = np.arange(len(key)), self._slots(key)
        while todo.size:
            free = slot[at] < 0
            slot[at[free]] = todo[free]
            again = slot[at] != todo
            todo, at = todo[again], (at[again] + 1) & self.mask
        taken = slot >= 0
        self.key = np.full(len(slot), -1, dtype=np.int64)
        self.target, self.output = np.zeros(len(slot), dtype=np.int32), np.zeros(len(slot), dtype=np.int32)
        self.key[taken], self.target[taken], self.output[taken] = key[slot[taken]], target[slot[taken]], output[slot[taken]]

    def _slots(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """Slot of each transition, -1 where there is none."""
        at = self._slots(key)
        there = self.key[at]
        away = np.flatnonzero((there != key) & (there >= 0))
        at[there < 0] = -1
        while away.size:
            next_at = (at[away] + 1) & self.mask
            there = self.key[next_at]
            at[away] = np.where(there < 0, -1, next_at)
            away = away[(there != key[away]) & (there >= 0)]
        return at

    def ordinals(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Rank of each term ``data[start:start + length]`` (length at least
        1) in its part; -1 if the part does not have it or is -1."""
        found = np.full(len(start), -1, dtype=np.int64)
        rows = np.flatnonzero(part >= 0)
        state, rank, at = self.roots[part[rows]], self.first[part[rows]].copy(), 0
        while rows.size:
            slot = self._find(state << 8 | data[start[rows] + at])
            on = slot >= 0
            rows, slot = rows[on], slot[on]
            state = self.target[slot].astype(np.int64)
            rank = rank[on] + self.output[slot]
            at += 1
            ended = length[rows] == at
            accepted = ended & self.final[state]
            found[rows[accepted]] = rank[accepted]
            rows, state, rank = rows[~ended], state[~ended], rank[~ended]
        return found


# ------------------------------------------------------------------ terms

#: Bytes of terms, lower-cased: letters of ASCII, and all bytes of others.
_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IN_TERM = ((LOWER >= 97) & (LOWER <= 122)) | (_BYTES >= 128)
#: For ``bytes.translate``: lower-cased terms between spaces.
SPACED = np.where(IN_TERM, LOWER, 32).astype(np.uint8).tobytes()


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a string array without nulls, end to
    end, and where each begins (and the last ends)."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def term_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text number of every term of the texts
    ``data[at[k]:at[k + 1]]``."""
    inside = IN_TERM[data]
    opens = at[:-1][at[:-1] < at[1:]]  # first bytes of texts
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    begin[opens] = inside[opens]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    closes = at[1:][at[:-1] < at[1:]] - 1
    end[closes] = inside[closes]
    start = np.flatnonzero(begin)
    return start, np.flatnonzero(end) + 1 - start, np.searchsorted(at, start, side="right") - 1
