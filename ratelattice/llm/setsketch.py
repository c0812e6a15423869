"""Near-duplicate documents by SetSketch registers.

A document's set holds the hashes of its distinct word shingles.  Its sketch is one byte per
register: the smallest of exponentially distributed hash values of the set, on an exponential
scale and truncated to 0..255, so that the sketch of a union is the larger register each time.
Equal registers are about as likely as the resemblance of two sets, which makes bands of
registers locality-sensitive; the number of bands follows from the wanted miss rate.

1. Equal sets form one class, held by its smallest doc_id.
2. Classes that share a band meet in a bucket.  Each member is compared with the bucket's
   smallest member, then, only in buckets that are not yet in one piece, members of different
   pieces with each other, in blocks.  A pair stays when the likelihood of the registers and
   set sizes does not rule the threshold out.
3. These pairs are verified on the full sets by exact intersection counts.  A piece that false
   pairs held together has all its pairs counted, in blocks of bounded size; only a spanning
   forest of each block leaves its task.
4. Verified links are joined into components.

No step emits the pairs of a group and no bucket is cut off: a large group costs more blocks.
Null or blank texts have empty sets and stay alone.  Rows that share a doc_id are one
document; rows without doc_id are linked with nothing and get no component.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelattice.llm.common import Forest, blocks, components, groups
from ratelattice.sources.kept import keep

BASE, RATE, TOP = 1.11, 20.0, 255  # scale of the registers: base, rate of the exponentials, largest value
LOG_RATIO = 12.0  # a pair goes if its likeliest resemblance is e**12 times likelier than the threshold
_WORDS_CACHED = 200_000


def band_plan(threshold: float, rows: int = 5, missed: float = 1e-6) -> tuple[int, int]:
    """(bands, registers per band) that miss a pair at ``threshold`` with probability ``missed`` at most."""
    return math.ceil(math.log(missed) / math.log(1 - threshold**rows)), rows


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < _WORDS_CACHED:
            self[word] = value
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, words: int, hashes: dict) -> np.ndarray:
    """Sorted hashes of the distinct word shingles; A-Z lowered, words split at ASCII white space."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    found = np.fromiter(map(hashes.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    width = min(words, len(tokens))
    rolled = np.full(len(found) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + found[i : len(found) - width + 1 + i]
        rolled ^= rolled >> np.uint64(29)
    return np.unique(_mixed(rolled))


def registers(sets: list[np.ndarray], count: int) -> np.ndarray:
    """Sketches (sets x registers) of non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    seeds = _mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    lowest = np.empty((len(sets), count), dtype=np.uint64)
    for i in range(count):
        values = (flat ^ seeds[i]) * (seeds[count + i] | np.uint64(1))
        values ^= values >> np.uint64(32)
        values *= np.uint64(0xC4CEB9FE1A85EC53)
        lowest[:, i] = np.minimum.reduceat(values, starts)
    uniform = (lowest.astype(np.float64) + 0.5) / 2.0**64
    values = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(values) / math.log(BASE)), 0, TOP).astype(np.uint8)


def merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Sketch of the union of two sketched sets."""
    return np.maximum(one, other)


def _higher(x: np.ndarray) -> np.ndarray:
    """Probability that the register of one set is the larger, for the share x that it holds alone."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)


def log_likelihood(above: np.ndarray, below: np.ndarray, m: int, n_a: np.ndarray, n_b: np.ndarray, resemblance) -> np.ndarray:
    """Joint log likelihood of the register comparisons at a resemblance, given the set sizes."""
    a, b = n_a / (n_a + n_b), n_b / (n_a + n_b)
    p, q = _higher(a - b * resemblance), _higher(b - a * resemblance)
    tiny = 1e-12
    equal = m - above - below
    return above * np.log(p + tiny) + below * np.log(q + tiny) + equal * np.log(np.maximum(1 - p - q, tiny))


def estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Likeliest resemblance of each pair of sketches, and its log likelihood, over a grid of 1/100."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    most = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    best, likeliest = np.full(len(n_a), -np.inf), np.zeros(len(n_a))
    for step in range(101):
        at = most * step / 100
        value = log_likelihood(above, below, a.shape[1], n_a, n_b, at)
        likeliest, best = np.where(value > best, at, likeliest), np.maximum(value, best)
    return likeliest, best


def plausible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the resemblance of each pair may reach the threshold."""
    ratio = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    may = ratio >= threshold - 1e-12
    if may.any():
        a, b, n_a, n_b = a[may], b[may], n_a[may], n_b[may]
        above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
        likelihood = lambda at, rows: log_likelihood(above[rows], below[rows], a.shape[1], n_a[rows], n_b[rows], at)
        every = np.arange(len(n_a))
        at = likelihood(threshold, every)
        # the likelihood has one peak: where it falls below the threshold, that side needs no search
        low = every[likelihood(threshold - 0.01, every) > at]
        best = at[low]
        for step in range(1, 20):
            best = np.maximum(best, likelihood(threshold * step / 20, low))
        stays = np.ones(len(every), dtype=bool)
        stays[low] = best - at[low] <= LOG_RATIO
        may[may] = stays
    return may


def sketches(docs: DataFrame, words: int, count: int) -> DataFrame:
    """Per row: doc_id, n_shingles, digest of the set, registers (empty for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start in range(0, batch.num_rows, 64):
                sets = [shingle_set(t, words, hashes) for t in texts.slice(start, 64).to_pylist()]
                full = [s for s in sets if len(s)]
                made = iter(registers(full, count) if full else ())
                yield pa.record_batch(
                    [
                        ids.slice(start, 64),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else b"" for s in sets], pa.binary()),
                        pa.array([next(made).tobytes() if len(s) else b"" for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "digest", "registers"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, registers binary")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(len(values), -1)


def _forest_rows(table: pa.Table, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    ids = table.column("node").to_numpy()
    a, b = (np.array([ids[p[i]] for p in pairs], dtype=np.int64) for i in (0, 1))
    return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])


def _compare_centres(threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n_a, n_b = (batch.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b"))
                stay = plausible(_matrix(batch.column("r_a")), _matrix(batch.column("r_b")), n_a, n_b, threshold)
                yield batch.select(["a", "b"]).filter(pa.array(stay))

    return run


def _compare_blocks(threshold: float) -> Callable:
    """Plausible pairs between members of different pieces, as a forest per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "key", "__i", "__j"):
            if group.num_rows < 2:
                continue
            regs, n = _matrix(group.column("registers")), group.column("n").to_numpy().astype(np.float64)
            piece, part = group.column("piece").to_numpy().copy(), group.column("__part").to_numpy()
            crossing = group.column("__i")[0].as_py() != group.column("__j")[0].as_py()
            pairs = []
            for i in range(len(n) - 1):
                # pieces that have met count as one, so their members need no further comparison
                other = i + 1 + np.flatnonzero(piece[i + 1 :] != piece[i])
                other = other[part[other] != part[i]] if crossing else other
                if len(other):
                    stay = plausible(regs[other], np.broadcast_to(regs[i], (len(other), regs.shape[1])), n[other], np.full(len(other), n[i]), threshold)
                    met, first = np.unique(piece[other[stay]], return_index=True)
                    pairs += [(i, int(j)) for j in other[stay][first]]
                    piece[np.isin(piece, met)] = piece[i]
            if pairs:
                yield _forest_rows(group, pairs)

    return run


def linked_pairs(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Matrix of the pairs with den * intersection >= num * union, from exact intersection counts."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, where, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1
    column = np.cumsum(shared) - 1
    picked = shared[where]
    rows, columns = owner[picked], column[where[picked]]
    common = np.zeros((len(sets), len(sets)), dtype=np.float64)
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    for first in range(0, int(shared.sum()), 4096):
        lo, hi = np.searchsorted(columns, (first, first + 4096))
        held = np.zeros((len(sets), 4096), dtype=np.float32)
        held[rows[lo:hi], columns[lo:hi] - first] = 1
        common += held @ held.T
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    return den * common >= num * (sizes[:, None] + sizes[None, :] - common)


def _verify_blocks(num: int, den: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "piece", "__i", "__j"):
            if group.num_rows < 2:
                continue
            sets = [np.frombuffer(s, dtype=np.uint64) for s in group.column("shingles").to_pylist()]
            forest = Forest(len(sets))
            first: dict[int, int] = {}
            for i, part in enumerate(group.column("part").to_pylist()):
                forest.union(first.setdefault(part, i), i)  # linked already
            pairs = [(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(linked_pairs(sets, num, den), 1)), strict=True) if forest.union(int(i), int(j))]
            if pairs:
                yield _forest_rows(group, pairs)

    return run


def _verify_edges(num: int, den: int) -> Callable:
    """The edges that hold on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            holds = []
            for one, other in zip(batch.column("s_a"), batch.column("s_b"), strict=True):
                a, b = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (one, other))
                both = len(np.intersect1d(a, b, assume_unique=True))
                holds.append(den * both >= num * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(holds, pa.bool_()))

    return run


def _shingle_rows(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = [shingle_set(t, words, hashes).tobytes() for t in part.column(2).to_pylist()]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(sets, pa.binary())], names=["node", "piece", "shingles"])

    return run


def _bucket_edges(classes: DataFrame, bands: int, rows: int, threshold: float) -> DataFrame:
    """Edges (a, b) whose pieces hold every pair that shares a band and may reach the threshold."""
    band = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring("registers", i * rows + 1, F.lit(rows))))
    members = classes.select(F.col("doc_id").alias("node"), F.explode(band).alias("key"))
    buckets = keep(members.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("centre")).filter("size > 1"), "buckets")
    members = keep(members.join(buckets, "key"), "members")
    sketch = classes.select("doc_id", "n_shingles", "registers")
    one, other = (sketch.toDF(side, f"n_{side}", f"r_{side}") for side in "ab")
    pairs = members.filter("node > centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    centred = keep(pairs.join(one, "a").join(other, "b").mapInArrow(_compare_centres(threshold), "a bigint, b bigint"), "centred")

    pieces = components(centred)
    placed = members.join(pieces, "node", "left").select("key", "node", "size", F.coalesce("component", "node").alias("piece"))
    placed = keep(placed, "placed")
    apart = placed.groupBy("key").agg(F.min("piece").alias("low"), F.max("piece").alias("high"), F.count("*").alias("n")).filter("low < high and n > 2")
    apart = keep(apart.select("key"), "apart")
    open_rows = placed.join(apart, "key").join(sketch.toDF("node", "n", "registers"), "node")
    cut = blocks(open_rows.select("key", "node", "piece", "size", "n", "registers"), "key", "node", "size", 128, 2048, share=4)  # a row costs more than a pair
    return centred.union(keep(cut.mapInArrow(_compare_blocks(threshold), "a bigint, b bigint"), "crossing"))


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, rows: int = 5) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest linked doc_id), kept.

    Two documents are linked when den * intersection >= num * union of their shingle sets.
    """
    bands, rows = band_plan(num / den, rows)
    sketched = keep(sketches(docs, words, bands * rows), "sketches")
    full = sketched.filter("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.max("registers").alias("registers"))
    classes = keep(classes, "classes")
    edges = keep(_bucket_edges(classes, bands, rows, num / den).distinct(), "edges")
    pieces = components(edges)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), F.col("text").cast("string").alias("text"))
    held = texts.join(pieces.hint("merge"), "node").select("node", F.col("component").alias("piece"), "text")
    sets = keep(held.mapInArrow(_shingle_rows(words), "node bigint, piece bigint, shingles binary").filter(F.length("shingles") > 0).dropDuplicates(["node", "shingles"]), "sets")

    # the edges that formed a piece first; only a piece that falls apart without the false ones needs its other pairs
    one, other = (sets.select(F.col("node").alias(side), F.col("shingles").alias(f"s_{side}")) for side in "ab")
    near = keep(edges.join(one, "a").join(other, "b").mapInArrow(_verify_edges(num, den), "a bigint, b bigint"), "near")
    parts = components(near)
    placed = pieces.join(parts.withColumnRenamed("component", "part"), "node", "left").select("node", F.col("component").alias("piece"), F.coalesce("part", "node").alias("part"))
    placed = keep(placed, "parts")
    apart = placed.groupBy("piece").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("size")).filter("low < high and size > 2")
    open_sets = sets.join(placed, ["node", "piece"]).join(apart.select("piece", "size"), "piece")
    cut = blocks(open_sets, "piece", "node", "size", 128, 2048)
    links = near.union(keep(cut.mapInArrow(_verify_blocks(num, den), "a bigint, b bigint"), "links"))

    owners = classes.select("digest", F.col("doc_id").alias("node"))
    placed = owners.join(components(links), "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    placed = keep(placed, "placed")
    alone = sketched.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    found = full.join(placed, "digest").select("doc_id", "n_shingles", "component_id")
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
