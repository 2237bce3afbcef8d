"""Token counts, SentencePiece codec and packing against the libraries."""

import math
import random
import zlib
from array import array
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortlens.llm import packing, sentencepiece_codec, token_counts
from cohortlens.llm.common import tokenizer_path

BYTE, WORD, PIECE = (tokenizer_path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
PARTS = ["a", "b", "the", "'", "'s", "'re", "'r", "'v", "'ll", "l", " ", "  ", "\n", "\t", "!", "...", "1", "23", "é", "ß", "漢", "　",
         "<|endoftext|>", "🙂", "e", "s", "\x1c", "_", "$$$", "́", "Ⅷ", "²", "I'm", "don't", "▁", "<s>", "<0x0A>", "\x85", " ", "Σ"]
texts = st.lists(st.sampled_from(PARTS), max_size=14).map("".join) | st.text(max_size=20)


@pytest.fixture(scope="module")
def machine():
    return token_counts.CountTransducer(BYTE)


@given(texts, st.sampled_from([1, 2, 3, 7, 1000]))
@settings(max_examples=600, deadline=None)
def test_transducer_counts_as_library(machine, text, chunk):
    text = text.encode("utf-8", "ignore").decode()
    assert machine.count(text, chunk) == len(_byte.encode(text, add_special_tokens=False).ids)


_byte, _word = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
_piece = sentencepiece.SentencePieceProcessor(model_file=PIECE)


def test_composition_is_associative(machine):
    text = "it's 12 o'clock, we'll  see\n\nsome　thing 'red'"
    maps = [machine.chunk_map(text[k:k + 5]) for k in range(0, len(text), 5)]
    left = right = None
    for m in maps:
        left = m if left is None else machine.compose(left, m)
    for m in reversed(maps):
        right = m if right is None else machine.compose(m, right)
    whole = lambda m: machine.compose(("", 0, machine.start), m)
    assert whole(left)[1] + machine.ends[whole(left)[2]] == whole(right)[1] + machine.ends[whole(right)[2]] == machine.count(text)


def test_tables_start_afresh(monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    monkeypatch.setattr(token_counts, "MAX_PIECES", 5)
    m, rng = token_counts.CountTransducer(BYTE), random.Random(1)
    for _ in range(50):
        text = "".join(rng.choice(PARTS) for _ in range(30))
        assert m.count(text) == len(_byte.encode(text, add_special_tokens=False).ids)


def test_white_space_classes(machine):
    every = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    for ch in every:
        assert machine.count(f"a{ch}b 1{ch}1") == len(_byte.encode(f"a{ch}b 1{ch}1", add_special_tokens=False).ids), hex(ord(ch))


def test_count_tokens_on_awkward_rows(awkward, empty):
    df, rows = awkward
    out = token_counts.count_tokens(df, BYTE, 100).collect()
    expected = Counter((r[0], len((r[1] or "").encode()), n := len(_byte.encode(r[1] or "", add_special_tokens=False).ids), n > 100) for r in rows)
    assert Counter(tuple(r) for r in out) == expected
    assert token_counts.count_tokens(empty, BYTE).count() == 0


@given(st.lists(texts, max_size=6))
@settings(max_examples=200, deadline=None)
def test_codec_as_library(many):
    many = [t.encode("utf-8", "ignore").decode() for t in many]
    codec = sentencepiece_codec._codec(PIECE)
    got = codec.encode(many)
    assert [g.tolist() for g in got] == [_piece.encode(t) for t in many]
    assert codec.decode(got) == [_piece.decode(_piece.encode(t)) for t in many]


def test_round_trip_on_awkward_rows(awkward, empty):
    df, rows = awkward
    out = sentencepiece_codec.round_trip(df, PIECE).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in out) == Counter(
        (r[0], tuple(i := _piece.encode(r[1] or "")), _piece.decode(i) if i else "") for r in rows)
    assert sentencepiece_codec.round_trip(empty, PIECE).count() == 0


def _check_packing(out, documents, capacity):
    expected = Counter()
    for doc_id, text in documents:
        ids = _word.encode(text or "", add_special_tokens=False).ids + [1]
        for n, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            expected[doc_id, n, a, len(part), zlib.crc32(array("I", part).tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == expected
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), math.ceil(sum(k[3] * n for k, n in expected.items()) / capacity)


@pytest.mark.parametrize("capacity,group", [(64, 20_000), (512, 7), (4096, 20_000)])
def test_packing_on_awkward_rows(awkward, empty, capacity, group):
    df, rows = awkward
    pieces = packing.token_pieces(df, WORD, capacity)
    out = packing.pack(pieces, capacity, group).collect()
    used, least = _check_packing(out, [(r[0], r[1]) for r in rows], capacity)
    assert used <= least * 1.35 + 1
    assert packing.pack_documents(empty, WORD).count() == 0


def test_pieces_carry_ids(awkward):
    df, rows = awkward
    out = packing.token_pieces(df, WORD, 4096, with_ids=True).collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in out)


@given(st.lists(st.integers(1, 100), min_size=1, max_size=120))
@settings(max_examples=150, deadline=None)
def test_local_search_keeps_pieces_and_empties_bins(lengths):
    before = [[i] for i in range(len(lengths))]
    squares = lambda bins: sum(sum(lengths[i] for i in b) ** 2 for b in bins)
    start = squares(before)
    after = packing.local_search([list(b) for b in before], lengths, 100, 100)
    assert sorted(i for b in after for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 100 for b in after)
    assert squares(after) >= start and len(after) <= len(before)
    fitted = packing.best_fit(lengths, 100)
    better = packing.local_search([list(b) for b in fitted], lengths, 100, 100)
    assert len(better) <= len(fitted)


def test_two_for_one_exchange():
    # 60+40 full; the giver's 30+25 replaces the taker's 50 and fills it.
    lengths = [30, 25, 50, 45]
    step = packing._best_step([0, 1], [2, 3], lengths, 5)
    assert step == (5, [1, 0], [2]) or step == (5, [0, 1], [2])
