"""Mixing sources to target weights by pivotal rounding.

Every source has a target share of all words, filled up by weight and limited to a multiple of
its own words.  A document of ``size`` words is wanted target / source words times; the whole
copies are certain and the fraction is rounded.  Rounding transfers words between two documents
of a source at a time, at random and fair, until the fraction of one of them is 0 or 1, so the
words of the pair stay the same.  What is left of a group of documents is one document with an
open fraction; these meet in the next level of a reduction tree, up to one per source, which is
rounded alone.  A source thus misses its target by less than one document.

Groups hold about ``FAN_IN`` documents at every level, so a hot source is many groups.  The
random draws are keyed by document, so reruns agree.  Documents without words are taken once
when wanted but weigh nothing; a null text has size 0.  A null source is a source of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelattice.llm.common import groups
from ratelattice.sources.kept import keep

FAN_IN = 256
_CLOSE = 1e-9


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            sizes = [len((t or "").encode("utf-8", "replace").split()) for t in part.column("text").to_pylist()]
            yield pa.record_batch([*(part.column(c) for c in ("doc_id", "source", "text_hash")), pa.array(sizes, pa.int64())], names=["doc_id", "source", "text_hash", "size"])


def numbered(sources: DataFrame) -> DataFrame:
    """Adds ``place``: 0, 1, 2 ... by code point, null last; the rows stay range-partitioned."""
    ranged = sources.repartitionByRange(F.col("source").isNull(), F.col("source"))
    held = keep(ranged.sortWithinPartitions(F.col("source").isNull(), F.col("source")).withColumn("__at", F.monotonically_increasing_id()), "ranged")
    held = held.withColumn("__part", F.shiftright("__at", 33)).withColumn("__within", F.col("__at") % F.lit(1 << 33))
    parts = held.groupBy("__part").agg(F.count("*").alias("__n"))  # one row per partition
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = parts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    return held.join(earlier, "__part").withColumn("place", F.col("__before") + F.col("__within")).drop("__at", "__part", "__within", "__before")


def with_targets(sources: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Adds ``target`` to (source, source_size): by weight, at most ``most`` times the size.

    Every target is min(most * size, level * weight); the level rises while sources fill up.
    One row of sums per step comes to the driver.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = keep(numbered(sources).withColumn("weight", weight), "weighed")
    full, level = F.lit(False), None
    while True:
        sums = weighed.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, most * F.col("source_size"))).alias("full"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if not sums["weight"]:
            break
        level, n = ((sums["all"] or 0) - (sums["full"] or 0)) / sums["weight"], sums["n"]
        full = most * F.col("source_size") <= F.lit(level) * F.col("weight")
        if weighed.filter(full).count() == n:
            break
    if level is None:
        return weighed.withColumn("target", most * F.col("source_size").cast("double"))
    return weighed.withColumn("target", F.least(most * F.col("source_size").cast("double"), F.lit(float(level)) * F.col("weight")))


def _draw(seed: int, level: int, key: int) -> float:
    return (xxhash.xxh3_64_intdigest(f"{seed} {level} {key}".encode()) >> 11) / float(1 << 53)


def round_group(fractions: list[float], sizes: list[int], draws: list[float]) -> tuple[list[float], int | None]:
    """Fractions after pairwise transfers of words, and the position that is still open."""
    out, held = list(fractions), None
    for i in range(len(out)):
        met = [i]
        if held is not None:
            j = held
            up = min((1 - out[i]) * sizes[i], out[j] * sizes[j])  # words that i can take from j
            down = min(out[i] * sizes[i], (1 - out[j]) * sizes[j])
            words = up if draws[i] * (up + down) < down else -down
            out[i] += words / sizes[i]
            out[j] -= words / sizes[j]
            met.append(j)
        held = None
        for k in met:
            if abs(out[k] - round(out[k])) < _CLOSE:
                out[k] = float(round(out[k]))
            else:
                held = k
    return out, held


def _rounds(seed: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "place", "bucket"):
            ids, sizes = group.column("draw_key").to_pylist(), group.column("size").to_pylist()
            after, held = round_group(group.column("fraction").to_pylist(), sizes, [_draw(seed, level, k) for k in ids])
            open_ = [i == held for i in range(len(after))]
            kept = group.select([c for c in group.column_names if c != "fraction"])
            made = kept.append_column("fraction", pa.array(after, pa.float64())).append_column("open", pa.array(open_, pa.bool_()))
            yield from made.combine_chunks().to_batches()

    return run


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 0) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, source, size, source_size, target, copies, taken (= copies * size).

    text_hash is xxhash64 of the text, which tells rows with one doc_id apart.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    sized = keep(rows.mapInArrow(_counted, "doc_id bigint, source string, text_hash bigint, size bigint").withColumn("row_id", F.monotonically_increasing_id()), "sized")
    sums = keep(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "sources")
    aimed = keep(with_targets(sums, weights, most).withColumnRenamed("source", "name"), "aimed")

    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(ratio + _CLOSE), F.lit(most))
    joined = sized.join(aimed, F.col("source").eqNullSafe(F.col("name"))).withColumns(
        {"whole": whole, "fraction": F.greatest(ratio - whole, F.lit(0.0)), "draw_key": F.xxhash64("doc_id", "size", F.lit(seed)), "buckets": F.ceil(F.col("n") / FAN_IN)}
    )
    fields = "doc_id bigint, source string, text_hash bigint, row_id bigint, size bigint, source_size bigint, target double, whole bigint, place bigint, draw_key bigint, buckets bigint, bucket bigint"
    names = [f.split()[0] for f in fields.split(", ")]
    joined = keep(joined.withColumn("bucket", F.pmod("draw_key", "buckets")).select(*names, "fraction"), "wanted")

    settled = F.abs(F.col("fraction") - F.round("fraction")) < _CLOSE
    done = [joined.filter(settled | (F.col("size") == 0)).withColumn("fraction", F.round("fraction"))]
    left, level = joined.filter(~settled & (F.col("size") > 0)), 0
    while True:
        dealt = left.repartition("place", "bucket").sortWithinPartitions("place", "bucket", "draw_key", "doc_id", "row_id")
        made = keep(dealt.mapInArrow(_rounds(seed, level), f"{fields}, fraction double, open boolean"), "rounded")
        done.append(made.filter("not open").drop("open"))
        left = made.filter("open").drop("open")
        if not left.filter("buckets > 1").take(1):
            break
        left = left.withColumn("buckets", F.ceil(F.col("buckets") / FAN_IN)).withColumn("bucket", F.pmod("bucket", "buckets"))
        level += 1
    last = F.when(F.pmod(F.xxhash64("draw_key", F.lit(seed + 1)), F.lit(1 << 20)) / float(1 << 20) < F.col("fraction"), 1.0).otherwise(0.0)
    done.append(left.withColumn("fraction", last))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    copies = F.col("whole") + F.col("fraction").cast("bigint")
    return out.select("doc_id", "text_hash", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
