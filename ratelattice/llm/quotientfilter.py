"""Exact duplicates by counting quotient filters.

Texts count as equal when their normalised forms (ASCII white space deleted) have the same bytes.

1. Every row gets a 64-bit fingerprint of its normalised text.
2. Each partition builds counting quotient filters: a fingerprint's high bits, the quotient, name
   the slot range, and a range keeps its sorted remainders with their counts.  Ranges of the same
   quotient merge without loss by merging sorted remainders and adding counts, so a fingerprint
   leaves a partition once however often it occurs.
3. Fingerprints counted once are settled.  The rows of the others go to byte verification: each
   is compared with the first row of its fingerprint (smallest doc_id), and rows that differ from
   it form the next round, until none is left.

A hot fingerprint is one entry per filter; its rows meet only their own first row, over a join
that can be split.  A null text counts as empty; all blank texts are equal.  Of equal rows the
one with the most code points in the original text stays, then the smallest doc_id (null last);
of repeated rows exactly one stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelattice.llm.common import groups
from ratelattice.sources.kept import keep

_WHITE = b" \t\n\x0b\x0c\r"
RANGE_ROWS = 65536  # rows of the input per slot range, on average


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").translate(None, _WHITE)


def fingerprint(normal: bytes) -> int:
    """Signed 64-bit fingerprint."""
    value = xxhash.xxh3_64_intdigest(normal)
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            texts = part.column(1).to_pylist()
            normal = [normalised(t) for t in texts]
            yield pa.record_batch(
                [
                    part.column(0),
                    pa.array([len(t or "") for t in texts], pa.int64()),
                    pa.array([fingerprint(n) for n in normal], pa.int64()),
                    pa.array([hashlib.sha256(n).hexdigest() for n in normal], pa.string()),
                ],
                names=["doc_id", "n_chars", "fp", "text_sha256"],
            )


def _built(quotient_bits: int):
    """One filter per quotient and task: sorted remainders and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, np.ndarray] | None = None
        for batch in batches:
            for start in range(0, batch.num_rows, 1 << 20):
                values, counts = np.unique(batch.column(0).slice(start, 1 << 20).to_numpy().view(np.uint64), return_counts=True)
                held = _added([(values, counts)] if held is None else [held, (values, counts)])
                if len(held[0]) > 4 << 20:  # a full filter is handed on, a new one begun
                    yield _slots(*held, quotient_bits)
                    held = None
        if held is not None:
            yield _slots(*held, quotient_bits)

    return run


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Union of sorted fingerprints or remainders, counts added."""
    values, where = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    total = np.zeros(len(values), dtype=np.int64)
    np.add.at(total, where, np.concatenate([c for _, c in parts]))
    return values, total


def _slots(values: np.ndarray, counts: np.ndarray, quotient_bits: int) -> pa.RecordBatch:
    shift = np.uint64(64 - quotient_bits)
    quotients, remainders = values >> shift, values & np.uint64((1 << (64 - quotient_bits)) - 1)
    starts = [0, *(np.flatnonzero(quotients[1:] != quotients[:-1]) + 1), len(values)]
    cut = list(zip(starts[:-1], starts[1:], strict=True)) if len(values) else []
    return pa.record_batch(
        [
            pa.array([int(quotients[a]) for a, _ in cut], pa.int64()),
            pa.array([remainders[a:b].tobytes() for a, b in cut], pa.binary()),
            pa.array([counts[a:b].astype(np.int64).tobytes() for a, b in cut], pa.binary()),
        ],
        names=["quotient", "remainders", "counts"],
    )


def _merged(quotient_bits: int):
    """Merges the ranges of each quotient and gives back the fingerprints with a count above one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "quotient"):
            parts = [
                (np.frombuffer(r, dtype=np.uint64), np.frombuffer(c, dtype=np.int64))
                for r, c in zip(group.column("remainders").to_pylist(), group.column("counts").to_pylist(), strict=True)
            ]
            remainders, counts = _added(parts)
            again = counts > 1
            whole = remainders[again] | np.uint64(group.column("quotient")[0].as_py() << (64 - quotient_bits))
            yield pa.record_batch([pa.array(whole.view(np.int64)), pa.array(counts[again])], names=["fp", "n"])

    return run


def repeated_fingerprints(fps: DataFrame, rows: int) -> DataFrame:
    """(fp, n): the fingerprints of column ``fp`` that occur more than once, with their counts."""
    bits = max(6, min(40, (rows // RANGE_ROWS).bit_length()))
    built = fps.select("fp").mapInArrow(_built(bits), "quotient bigint, remainders binary, counts binary")
    dealt = built.repartition("quotient").sortWithinPartitions("quotient")
    return dealt.mapInArrow(_merged(bits), "fp bigint, n bigint")


def _verified(texts: DataFrame) -> DataFrame:
    """(fp, doc_id, first): the smallest doc_id of the fingerprint whose row has the same bytes.

    Takes distinct rows (fp, doc_id, normal).
    """
    open_rows, done = texts, None
    while True:
        first = keep(open_rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "first")
        if not first.take(1):
            return done
        chosen = open_rows.join(first.withColumnRenamed("first", "doc_id"), ["fp", "doc_id"])
        chosen = keep(chosen.groupBy("fp", F.col("doc_id").alias("first")).agg(F.min("normal").alias("bytes")), "chosen")
        compared = keep(open_rows.join(chosen, "fp").withColumn("same", F.col("normal") == F.col("bytes")).drop("bytes"), "compared")
        same = compared.filter("same").select("fp", "doc_id", F.sha2("normal", 256).alias("text_sha256"), "first")
        done = same if done is None else done.unionByName(same)
        open_rows = compared.filter("not same").select("fp", "doc_id", "normal")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    printed = rows.mapInArrow(_fingerprints, "doc_id bigint, n_chars bigint, fp bigint, text_sha256 string")
    printed = keep(printed.withColumn("row_id", F.monotonically_increasing_id()), "fingerprints")
    again = keep(repeated_fingerprints(printed, printed.count()), "again")

    routed = keep(printed.join(again.select("fp"), "fp"), "routed")
    single = printed.join(again.select("fp"), "fp", "left_anti")
    # a missing doc_id is compared under a number of its own
    number = F.coalesce(F.col("doc_id"), -1 - F.col("row_id"))
    wanted = routed.select("doc_id").filter("doc_id is not null").distinct()
    normal = F.encode(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]", ""), "UTF-8")
    known = rows.join(wanted.hint("merge"), "doc_id").select("doc_id", normal.alias("normal"))
    nameless = rows.filter("doc_id is null").select("doc_id", normal.alias("normal"))
    texts = known.union(nameless).withColumn("text_sha256", F.sha2("normal", 256))
    texts = texts.withColumnRenamed("doc_id", "text_of").dropDuplicates(["text_of", "text_sha256"])
    met = routed.withColumn("number", number).join(
        texts, F.col("doc_id").eqNullSafe(F.col("text_of")) & (routed["text_sha256"] == texts["text_sha256"])
    )
    verified = _verified(keep(met.select("fp", F.col("number").alias("doc_id"), "normal").distinct(), "texts"))
    if verified is None:
        classed = routed.limit(0).withColumn("first", F.lit(0).cast("bigint"))
    else:
        names = verified.withColumnRenamed("doc_id", "number")
        classed = routed.withColumn("number", number).join(names, ["fp", "number", "text_sha256"]).drop("number")
    classed = keep(classed, "classed")

    best = F.max_by(F.struct("doc_id", "row_id"), F.struct("n_chars", -F.coalesce("doc_id", F.lit(2**63 - 1)), -F.col("row_id"))).alias("best")
    best = keep(classed.groupBy("fp", "first", "text_sha256").agg(best, F.count("*").alias("group_size")), "best")
    grouped = classed.join(best, ["fp", "first", "text_sha256"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"),
        "text_sha256",
    )
    alone = single.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    return grouped.unionByName(alone)
