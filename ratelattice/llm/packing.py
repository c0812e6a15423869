"""Cost-balanced packing of token ids into sequences.

A document's ids are those of its text and one closing id.  Full sequences are cut off long
documents; the pieces that remain are packed in chunks of documents of one task: in descending
length, each piece goes to the sequence of lowest cost (linear plus quadratic in the piece's
length, as attention stays inside a piece) that still has the capacity.  A chunk has just as
many sequences as its ids fill; a piece that fits nowhere whole is cut over the free places.
The ids beyond the last full sequence become sequences with a power of two ids, which need no
padding, so a chunk has none at all.

Packing needs no shuffle: chunks follow the input partitions, a task holds one chunk of pieces
at a time, and a task run again gives the same pieces and numbers.  Null and empty texts hold
only the closing id.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY, CLOSING_ID = 1024, 0
CHUNK_PIECES = 4096  # pieces packed together; bounds the memory of a task
LINEAR, QUADRATIC = 1.0, 1.0 / 512  # cost of a piece: LINEAR * n + QUADRATIC * n * n
_WORDS_CACHED, _WORD_CHARS = 800_000, 48
# Fixed value: how this family of byte-level vocabularies cuts texts into words
_WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT, _NO_CUT = re.compile(r" (?=\S)"), re.compile(r" (?:\s|$)")


class IdSource:
    """Little-endian uint32 ids of texts, as ``tokenizers`` gives them for a byte-level BPE file.

    A space before a character that isn't white space always begins a new word for this kind of
    tokenizer, so a text is cut at such spaces and every word is encoded once and remembered.
    New words are encoded as one text and told apart by the byte lengths of their ids.  The merges
    are done by ``tiktoken`` over the vocabulary of the file, several times as fast as
    ``tokenizers``, whose ids the tests compare.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        source = Tokenizer.from_file(path)
        special = {t.content: i for i, t in source.get_added_tokens_decoder().items()}
        plain = {c: b for b, c in enumerate(_byte_characters())}
        assert set(pre_tokenizers.ByteLevel.alphabet()) == set(plain)
        ranks = {bytes(plain[c] for c in t): i for t, i in source.get_vocab().items() if t not in special}
        self._encoding = tiktoken.Encoding("file", pat_str=_WORD, mergeable_ranks=ranks, special_tokens=special)
        self._bytes = np.zeros(max([*ranks.values(), *special.values()]) + 1, dtype=np.int64)
        for token, i in [*ranks.items(), *((t.encode(), i) for t, i in special.items())]:
            self._bytes[i] = len(token)
        self._known: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._encoding.encode(text, allowed_special="all"), dtype="<u4")

    def _learn(self, words: list[str]) -> None:
        """Remembers the ids of the words, each with a space before it."""
        text = " ".join(["", *words])
        ids = self.encode(text)
        ends = np.cumsum([1 + len(w.encode()) for w in words])
        ends = (4 * (np.searchsorted(np.cumsum(self._bytes[ids]), ends) + 1)).tolist()
        whole, start = ids.tobytes(), 0
        for word, end in zip(words, ends, strict=True):
            self._known[word] = whole[start:end]
            start = end

    @staticmethod
    def words(text: str) -> list[str]:
        """Pieces of the text, cut at each space that a visible character follows; the space goes."""
        if not _NO_CUT.search(text):
            return text.split(" ")
        cuts = [m.start() for m in _CUT.finditer(text)]
        return [text[a + 1 : b] for a, b in zip([-1, *cuts], [*cuts, len(text)], strict=True)]

    def ids(self, texts: list[str]) -> list[bytes]:
        cut = [self.words(t.encode("utf-8", "replace").decode()) for t in texts]
        heads = [self.encode(words.pop(0)).tobytes() for words in cut]
        if len(self._known) > _WORDS_CACHED:
            self._known = {}
        new = list(set().union(*cut).difference(self._known))
        if new:
            self._learn(new)
        look = self._known.__getitem__
        out = [head + b"".join(map(look, words)) for head, words in zip(heads, cut, strict=True)]
        for word in new:
            if len(word) > _WORD_CHARS:
                del self._known[word]
        return out


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


@cache
def id_source(path: str) -> IdSource:
    """One source per Python worker, so tasks share the words seen."""
    return IdSource(path)


def cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def powers(n: int) -> list[int]:
    """Powers of two, largest first, that add up to n."""
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


class _Places:
    """Sequences by the places they have free: a heap by (cost, sequence) per number of places, and the least of each range of numbers."""

    def __init__(self, places: int):
        self.leaves = 1 << places.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(self.leaves)]
        self.least: list[tuple[float, int] | None] = [None] * (2 * self.leaves)

    def _renew(self, free: int) -> None:
        i = free + self.leaves
        self.least[i] = self.heaps[free][0] if self.heaps[free] else None
        while i > 1:
            i //= 2
            one, other = self.least[2 * i], self.least[2 * i + 1]
            self.least[i] = other if one is None else one if other is None else min(one, other)

    def put(self, free: int, entry: tuple[float, int]) -> None:
        heapq.heappush(self.heaps[free], entry)
        self._renew(free)

    def take(self, free: int) -> tuple[float, int]:
        entry = heapq.heappop(self.heaps[free])
        self._renew(free)
        return entry

    def cheapest(self, least_free: int) -> tuple[float, int] | None:
        """The cheapest sequence with so many free places at least."""
        best, i, j = None, least_free + self.leaves, 2 * self.leaves
        while i < j:
            if i & 1:
                found = self.least[i]
                best = found if best is None or (found is not None and found < best) else best
                i += 1
            i, j = i // 2, j // 2  # the range reaches to the last leaf
        return best

    def widest(self) -> int:
        i = 1
        while i < self.leaves:
            i = 2 * i + (self.least[2 * i + 1] is not None)
        return i - self.leaves


def pack(lengths: list[int]) -> list[list[tuple[int, int, int, int]]]:
    """Per piece its parts (start in the piece, length, sequence, offset); no place stays empty.

    Every sequence holds ``CAPACITY`` ids, but for the last ones, which hold powers of two.  A
    piece goes to the cheapest sequence that takes it whole, else what fits of it to the widest
    one (the cheapest of those).
    """
    whole, rest = divmod(sum(lengths), CAPACITY)
    room = [CAPACITY] * whole + powers(rest)
    free, spent = list(room), [0.0] * len(room)
    places = _Places(CAPACITY)
    for s, n in enumerate(room):
        places.heaps[n].append((0.0, s))  # in order, hence a heap
    for n in set(room):
        places._renew(n)
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in lengths]
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at, n = 0, lengths[piece]
        while at < n:
            found = places.cheapest(n - at)
            spot = places.take(free[found[1]] if found else places.widest())[1]
            part = min(free[spot], n - at)
            out[piece].append((at, part, spot, room[spot] - free[spot]))
            free[spot] -= part
            spent[spot] += cost(part)
            at += part
            if free[spot]:
                places.put(free[spot], (spent[spot], spot))
    return out


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


class _Task:
    """Pieces of one task; rows come out as batches."""

    def __init__(self, with_ids: bool):
        self.next = TaskContext.get().partitionId() << 36
        self.with_ids, self.rows, self.pieces = with_ids, [], []

    def row(self, doc_id, ids: bytes, start: int, total: int, sequence: int, offset: int) -> None:
        self.rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset, ids if self.with_ids else None))

    def document(self, doc_id, ids: bytes) -> None:
        total, step = len(ids) // 4, 4 * CAPACITY
        full = len(ids) - len(ids) % step
        for a in range(0, full, step):
            self.row(doc_id, ids[a : a + step], a // 4, total, self.next, 0)
            self.next += 1
        if full < len(ids):
            self.pieces.append((doc_id, ids[full:], full // 4, total))

    def packed(self) -> None:
        most = 0
        for (doc_id, ids, start, total), parts in zip(self.pieces, pack([len(p[1]) // 4 for p in self.pieces]), strict=True):
            for at, n, sequence, offset in parts:
                self.row(doc_id, ids[4 * at : 4 * (at + n)], start + at, total, self.next + sequence, offset)
                most = max(most, sequence + 1)
        self.next += most
        self.pieces = []

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(_NAMES)
        self.rows = []
        return pa.record_batch([*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.binary())], names=_NAMES)


def pack_documents(docs: DataFrame, tokenizer_path: str, with_ids: bool = True) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (uint32, little-endian).

    ``tokenizer_path`` names a tokenizer file that every executor can read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, task = id_source(tokenizer_path), _Task(with_ids)
        closing = CLOSING_ID.to_bytes(4, "little")
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), source.ids(texts), strict=True):
                    task.document(doc_id, ids + closing)
                if len(task.pieces) >= CHUNK_PIECES:
                    task.packed()
                if len(task.rows) >= CHUNK_PIECES:
                    yield task.batch()
        task.packed()
        yield task.batch()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    packed = rows.mapInArrow(run, _SCHEMA)
    return packed if with_ids else packed.drop("ids")
