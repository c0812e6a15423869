"""Hard negatives by exact integer inner products, several candidates to one wide integer.

Components become integers.  Those of several candidates, biased so that none is negative, lie
in separated fields of one wide integer, wide enough for the largest sum of products; one
multiplication by an anchor's (biased) component then serves all of them, and the sums are
read out of the fields and freed of the bias.  The field width follows from the numbers at
hand.  Where two fields or more fit into 53 bits a double carries the wide integer exactly
and the products of many anchors are one matrix product; else Python's integers carry it.

Anchors are broadcast in blocks of bounded size, all rows stream past each block, and every
task keeps one bounded heap per anchor (positives) or per anchor and positive (negatives).
The heaps of the tasks are merged by a window.  No pair leaves its task otherwise.

Rows with a null vec_id, label or vector, or with a null or non-finite component, take no part.
Shorter vectors count as filled up with zeros.  Repeated rows are rows of their own; a row is
no positive of an anchor with the same vec_id.  Components and scores beyond 64 bits count as its ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelattice.llm.common import Heaps
from ratelattice.skew import running_total
from ratelattice.sources.kept import keep, shared_folder

CARRIER_BITS = 53  # integers that a double holds exactly
WIDE_FIELDS = 32  # fields of a wide integer that no double can carry
BLOCK_ANCHORS, BLOCK_BYTES = 4096, 16 << 20  # bounds of a broadcast block of anchors
CELLS = 1 << 21  # scores computed at once
LONG = np.iinfo(np.int64)
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def field_bits(dims: int, top_a: int, top_c: int) -> int:
    """Bits of a field that holds any sum of ``dims`` products of numbers up to the given ones."""
    return max(1, int(dims * top_a * top_c).bit_length())


def packed(candidates: np.ndarray, bits: int, fields: int) -> np.ndarray:
    """(dims x wide integers) from non-negative components (rows x dims); rows beyond the last fill up with zeros."""
    n, dims = candidates.shape
    filled = np.zeros((-(-n // fields) * fields, dims), dtype=candidates.dtype)
    filled[:n] = candidates
    parts = filled.reshape(-1, fields, dims)
    wide = parts[:, 0].copy()
    for j in range(1, fields):
        shift = 1 << (bits * j)
        wide = wide + parts[:, j] * (shift if wide.dtype == object else wide.dtype.type(shift))
    return wide.T


def products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products (anchors x candidates) of integer rows, as longs; exact within 64 bits."""
    (n_a, dims), n_c = anchors.shape, len(candidates)
    if not n_a or not n_c or not dims:
        return np.zeros((n_a, n_c), dtype=np.int64)
    low_a, low_c = int(anchors.min()), int(candidates.min())
    bits = field_bits(dims, int(anchors.max()) - low_a, int(candidates.max()) - low_c)
    largest = dims * max(abs(low_a), abs(int(anchors.max()))) * max(abs(low_c), abs(int(candidates.max())))
    if bits * 2 <= CARRIER_BITS and 4 * largest <= LONG.max:
        fields, carrier = CARRIER_BITS // bits, np.float64
    else:
        fields, carrier, anchors, candidates = WIDE_FIELDS, object, anchors.astype(object), candidates.astype(object)
    wide = packed((candidates - low_c).astype(carrier), bits, fields)
    sums = (anchors - low_a).astype(carrier) @ wide
    sums = sums.astype(np.int64) if carrier is np.float64 else sums
    mask = (1 << bits) - 1
    found = np.stack([(sums >> (bits * j)) & mask for j in range(fields)], axis=2).reshape(n_a, -1)[:, :n_c]
    # sum (a - low_a)(c - low_c) = sum a c - low_c sum a - low_a sum c + dims low_a low_c
    found = found + low_c * anchors.sum(axis=1)[:, None] + low_a * candidates.sum(axis=1)[None, :] - dims * low_a * low_c
    return found if carrier is np.float64 else np.clip(found, LONG.min, LONG.max).astype(np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of integer components from a list column of whole doubles."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy()
    out = np.zeros((len(column), dims))
    out[np.arange(dims)[None, :] < sizes[:, None]] = flat
    if len(flat) and np.abs(flat).max() >= 2.0**31:
        return np.array([[int(x) for x in row] for row in out], dtype=object).reshape(out.shape)
    return out.astype(np.int64)


class Anchors:
    """A block of anchors: number in the block, vec_id, label and components."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray):
        self.ids, self.labels, self.values = ids, labels, values

    def parts(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, labels, components) of the rows of a batch, few enough at a time for ``CELLS``."""
        step = max(1, CELLS // max(1, len(self.ids)))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            ids, labels = (part.column(c).to_numpy() for c in (0, 1))
            yield ids, labels, _matrix(part.column(2), self.values.shape[1])


def _positives(sent, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Anchors = cloudpickle.loads(sent.value)
        heaps = Heaps(len(block.ids), k)
        for batch in batches:
            for ids, labels, values in block.parts(batch):
                for label in np.intersect1d(labels, block.labels):
                    mine, theirs = np.flatnonzero(block.labels == label), np.flatnonzero(labels == label)
                    scores = products(block.values[mine], values[theirs])
                    a, c = np.nonzero((scores >= heaps.least[mine][:, None]) & (block.ids[mine][:, None] != ids[theirs][None, :]))
                    heaps.offer(mine[a], scores[a, c], ids[theirs[c]])
        yield _kept(heaps, "anchor")

    return run


def _negatives(sent, k: int, lowest: int, highest: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, owner, given = cloudpickle.loads(sent.value)
        # lowest * p <= 100 s <= highest * p in whole numbers
        bottom = np.array([-(-lowest * int(p) // 100) for p in given], dtype=np.int64)
        top = np.array([highest * int(p) // 100 for p in given], dtype=np.int64)
        heaps = Heaps(len(owner), k, bottom)
        n = len(block.ids)
        first, last = (np.searchsorted(owner, np.arange(n), side) for side in ("left", "right"))
        ceiling = np.full(n, LONG.min)
        np.maximum.at(ceiling, owner, top)
        for batch in batches:
            for ids, labels, values in block.parts(batch):
                floor = np.full(n, LONG.max)
                np.minimum.at(floor, owner, heaps.least)
                scores = products(block.values, values)
                a, c = np.nonzero((scores >= floor[:, None]) & (scores <= ceiling[:, None]) & (block.labels[:, None] != labels[None, :]))
                slots = last[a] - first[a]
                which = np.repeat(np.arange(len(a)), slots)
                slot = first[a][which] + np.arange(len(which)) - np.repeat(np.cumsum(slots) - slots, slots)
                found = scores[a, c][which]
                fits = found <= top[slot]
                heaps.offer(slot[fits], found[fits], ids[c[which]][fits])
        yield _kept(heaps, "slot")

    return run


def _kept(heaps: Heaps, name: str) -> pa.RecordBatch:
    rows, scores, ids = heaps.settle()
    return pa.record_batch([pa.array(rows, pa.int64()), pa.array(scores, pa.int64()), pa.array(ids, pa.int64())], names=[name, "score", "id"])


def _merged(heaps: DataFrame, key: str, k: int) -> DataFrame:
    """The heaps of all tasks as one: k rows per key at most, numbered from 1."""
    order = Window.partitionBy(key).orderBy(F.desc("score"), "id")
    return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def usable(embeddings: DataFrame, label: Column | None = None) -> DataFrame:
    """(vec_id, label, parts) of the rows that take part; parts are the whole numbers floor(256 x), as doubles."""
    parts = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(256 * x).cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding")
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
    return rows.select("vec_id", (F.col("label") if label is None else label).alias("label"), parts.alias("parts"))


def hard_negatives(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, lowest: int = 30, highest: int = 90
) -> DataFrame:
    """Per anchor and positive of ``rows`` (vec_id, label, parts: see ``usable``): its first ``negatives`` rows of another label.

    ``anchor`` picks the anchors.  Positives are the first rows of the anchor's label; a negative's
    score lies between ``lowest`` and ``highest`` percent of the positive's.
    """
    spark = rows.sparkSession
    chosen = keep(rows.filter(anchor), "anchors")
    dims = chosen.agg(F.max(F.size("parts"))).first()[0] or 1
    size = max(1, min(BLOCK_ANCHORS, BLOCK_BYTES // (8 * dims)))
    numbered = running_total(chosen, [], ["vec_id"], "__before").withColumn("block", F.floor(F.col("__before") / size).cast("int"))
    numbered = keep(numbered.select("block", "vec_id", "label", "parts"), "blocks")
    folder = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}/negatives"
    blocks = [r["block"] for r in numbered.select("block").distinct().orderBy("block").collect()]
    for number in blocks:
        held = numbered.filter(F.col("block") == number).orderBy("vec_id").collect()  # a block of bounded size
        width = max(1, *(len(r["parts"]) for r in held))
        values = _matrix(pa.array([r["parts"] for r in held], pa.list_(pa.float64())), width)
        block = Anchors(*(np.array([r[c] for r in held], dtype=np.int64) for c in ("vec_id", "label")), values)
        found = _block_negatives(rows.select("vec_id", "label", F.slice("parts", 1, width).alias("parts")), block, positives, negatives, lowest, highest)
        found.write.parquet(f"{folder}/block={number}")
    if not blocks:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(f"{folder}/block=*")


def _block_negatives(rows: DataFrame, block: Anchors, positives: int, negatives: int, lowest: int, highest: int) -> DataFrame:
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(block))
    near = _merged(rows.mapInArrow(_positives(sent, positives), "anchor bigint, score bigint, id bigint"), "anchor", positives)
    near = near.orderBy("anchor", "rank").collect()  # ``positives`` rows per anchor of the block at most
    owner = np.array([r["anchor"] for r in near], dtype=np.int64)
    given = np.array([r["score"] for r in near], dtype=np.int64)
    sent = spark.sparkContext.broadcast(cloudpickle.dumps((block, owner, given)))
    far = _merged(rows.mapInArrow(_negatives(sent, negatives, lowest, highest), "slot bigint, score bigint, id bigint"), "slot", negatives)
    slots = [(i, int(block.ids[r["anchor"]]), r["id"], r["score"]) for i, r in enumerate(near)]
    named = spark.createDataFrame(slots, "slot bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    joined = far.join(F.broadcast(named), "slot")
    return joined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
