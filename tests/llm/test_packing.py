import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ratelattice.llm import packing
from ratelattice.llm.queries import tokenizer_path

from .tinydocs import ODD, documents, sentence

TEXTS = [
    "", " ", "  a", "a b  c ", "\n\n a\n b <|endoftext|> c<|endoftext|>", "it's 'll x  's", "a b c 　 d", "x \t y\n z 12 3.4",
    "日本 語  テ", " a \n\n  b\x1c c \x85d", "Ünï cödé✓ \U0001f600 x", "word" * 400, sentence(1, 300),
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def test_ids_are_those_of_the_tokenizer(tokenizer):
    source = packing.IdSource(tokenizer_path())
    for texts in (TEXTS, TEXTS[::-1]):
        for text, ids in zip(texts, source.ids(texts), strict=True):
            assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_restore_documents_and_fill_sequences(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_PIECES", 16)
    rows = ODD + [(i, t) for i, t in enumerate(TEXTS)] + [(1000 + i, sentence(i, 30 + 37 * i)) for i in range(40)]
    got = packing.pack_documents(documents(spark, rows), tokenizer_path()).collect()
    expected = defaultdict(list)
    for doc_id, text in rows:
        expected[doc_id].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [0])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert r.length == len(ids) > 0 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        pieces[r.doc_id].append((r.start, ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(expected)
    for doc_id, parts in pieces.items():
        if len(expected[doc_id]) == 1:
            assert [i for _, ids, _ in sorted(parts) for i in ids] == expected[doc_id][0]
            assert {n for _, _, n in parts} == {len(expected[doc_id][0])}
        else:
            assert sum(len(ids) for _, ids, _ in parts) == sum(map(len, expected[doc_id]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == 1024 or end & (end - 1) == 0


def test_packing_balances_cost():
    rng = np.random.default_rng(0)
    lengths = [int(n) for n in rng.integers(1, 1000, 500)]
    held, spent = defaultdict(int), defaultdict(float)
    for length, parts in zip(lengths, packing.pack(lengths), strict=True):
        assert sum(n for _, n, _, _ in parts) == length
        for _, n, sequence, _ in parts:
            held[sequence] += n
            spent[sequence] += packing.cost(n)
    full = [s for s in held if held[s] == packing.CAPACITY]
    assert len(full) >= len(held) - 10 and sum(held.values()) == sum(lengths)
    assert max(spent[s] for s in full) < 2.2 * np.mean([spent[s] for s in full])


def plain_pack(lengths):
    """The rule as it reads: search all sequences for the cheapest with room, else cut at the widest."""
    whole, rest = divmod(sum(lengths), packing.CAPACITY)
    room = [packing.CAPACITY] * whole + packing.powers(rest)
    free, spent, out = list(room), [0.0] * len(room), [[] for _ in lengths]
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at, n = 0, lengths[piece]
        while at < n:
            fits = [s for s in range(len(room)) if free[s] >= n - at]
            spot = min(fits, key=lambda s: (spent[s], s)) if fits else min((s for s in range(len(room)) if free[s]), key=lambda s: (-free[s], spent[s], s))
            part = min(free[spot], n - at)
            out[piece].append((at, part, spot, room[spot] - free[spot]))
            free[spot] -= part
            spent[spot] += packing.cost(part)
            at += part
    return out


@pytest.mark.parametrize("seed", range(4))
def test_every_piece_goes_where_the_full_search_puts_it(seed):
    rng = np.random.default_rng(seed)
    lengths = [int(min(1023, max(1, n))) for n in rng.lognormal(4 + seed / 2, 1.2, 700)]
    assert packing.pack(lengths) == plain_pack(lengths)
    assert packing.pack([1] * 5) == plain_pack([1] * 5) and packing.pack([]) == []


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, []), tokenizer_path()).collect() == []
