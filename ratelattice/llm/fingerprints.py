"""Document fingerprints: bottom-k sketches of shingle hashes.

The sketch of a text is the k smallest distinct hashes of its word shingles.  It is a sample of
the shingle set that depends on nothing else, so the sketch of a union is the k smallest of both,
and two sketches estimate resemblance, containment and the number of distinct shingles.  Sets
of fewer than k shingles are held whole, and their figures are exact.

All columns here are built-in functions.  Words are split at ASCII white space and lowered.  A
text of fewer words than a shingle is one shingle; a null or blank text has an empty sketch,
which resembles an empty one fully (1.0) and any other not at all (0.0).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, WORDS = 256, 5
_SHARE = 2.0**64


def word_hashes(text: Column) -> Column:
    words = F.split(F.lower(text), r"[\x20\x09-\x0D]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def with_sketch(df: DataFrame, text: str, out: str, k: int = K, words: int = WORDS) -> DataFrame:
    """Adds ``out``: the sketch (array<bigint>, ascending) of the column ``text``."""
    hashed = df.withColumn("__w", word_hashes(F.coalesce(F.col(text), F.lit(""))))
    rows = hashed.withColumn("__n", F.size("__w"))
    at = F.sequence(F.lit(0), F.col("__n") - words)
    shingle = F.transform(at, lambda i: F.xxhash64(*[F.get("__w", i + j) for j in range(words)]))
    short = F.when(F.col("__n") == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64("__w")))
    rows = rows.withColumn(out, F.when(F.col("__n") >= words, shingle).otherwise(short)).drop("__w", "__n")
    return rows.withColumn(out, F.slice(F.sort_array(F.array_distinct(out)), 1, k))


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(df: DataFrame, keys: Sequence[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch per group of ``keys``: the k smallest distinct hashes of its sketches.

    Each task passes on k hashes of a group at most, so a hot group costs no more than another.
    """
    hashes = df.select(*keys, F.explode(sketch).alias("__h")).distinct()
    ranked = hashes.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy("__h")))
    return ranked.filter(F.col("__r") <= k).groupBy(*keys).agg(F.sort_array(F.collect_list("__h")).alias(sketch))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    share = (F.element_at(sketch, k).cast("double") + 2.0**63) / _SHARE
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated intersection over union."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union).cast("double"))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, over the hashes that both sketches cover."""
    top = lambda s: F.when(F.size(s) < k, F.lit(2**63 - 1)).otherwise(F.element_at(s, -1))
    covered = F.filter(a, lambda h: h <= F.least(top(a), top(b)))
    share = F.size(F.array_intersect(covered, b)) / F.size(covered).cast("double")
    return F.when(F.size(a) == 0, 1.0).when(F.size(covered) == 0, 0.0).otherwise(share)


def text_of(sketch: Column) -> Column:
    """The sketch as a string: 16 hex digits per hash, ascending."""
    return F.lower(F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def _interval(bounds: Sequence[int], value: Column) -> Column:
    """Number of ``bounds`` (ascending) up to ``value``, by bisection."""
    if not bounds:
        return F.lit(0)
    held = F.array(*[F.lit(int(b)) for b in bounds]).cast("array<bigint>")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(bounds).bit_length()))])
    fits = lambda at: (at <= len(bounds)) & (F.get(held, at - 1) <= value)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(fits(at + step), at + step).otherwise(at))


def followed(df: DataFrame, order: str) -> DataFrame:
    """Rows of ``df`` cut into intervals of ``order`` (bigint), each with the first rows of the next one as guests.

    Adds __part, __guest and __order; the rows are partitioned by __part, so a window over
    (__part, ordered by __guest, __order) sees the next row of every row.  The first rows of all
    are guests of the last interval.  A missing ``order`` comes first.  Only the bounds of the
    intervals, a few per shuffle partition, come to the driver.
    """
    keyed = df.withColumn("__order", F.coalesce(F.col(order), F.lit(-(2**63))))
    parts = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = keyed.agg(F.percentile_approx("__order", [i / parts for i in range(1, parts)], 10 * parts)).first()[0]
    near = _interval(sorted(set(cuts or [])), F.col("__order"))
    firsts = sorted(r["first"] for r in keyed.groupBy(near.alias("part")).agg(F.min("__order").alias("first")).collect())
    low, bounds = (firsts or [None])[0], firsts[1:]
    placed = keyed.withColumn("__part", _interval(bounds, F.col("__order")))
    begins = F.col("__order") == F.get(F.array(*[F.lit(int(b)) for b in bounds]).cast("array<bigint>"), F.col("__part") - 1)
    host = F.when(F.col("__order") == F.lit(low), F.lit(len(bounds))).when((F.col("__part") > 0) & begins, F.col("__part") - 1)
    own, guest = (F.struct(p.cast("int").alias("part"), F.lit(g).alias("guest")) for p, g in ((F.col("__part"), False), (host, True)))
    sent = placed.withColumn("__to", F.explode(F.array_compact(F.array(own, F.when(host.isNotNull(), guest)))))
    dealt = sent.select(*df.columns, "__order", F.col("__to.part").alias("__part"), F.col("__to.guest").alias("__guest"))
    return dealt.repartition("__part")


def edited_fingerprints(docs: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """Per row of ``docs``: the fingerprint of its text and of its edited text, and how near they are.

    The edited text has the last quarter of the code points replaced by the beginning of the next
    document by doc_id (rows with one doc_id by text; after the last document: the first).
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sketched = with_sketch(followed(rows, "doc_id"), "text", "sketch", k, words)
    ahead = Window.partitionBy("__part").orderBy("__guest", "__order", "text")
    ahead = {"next_text": F.lead("text").over(ahead), "next_sketch": F.lead("sketch").over(ahead)}
    pairs = sketched.withColumns(ahead).filter(~F.col("__guest"))
    n = F.char_length("text").cast("bigint")
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    pairs = pairs.withColumn("n_chars", n).withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - quarter), F.left("next_text", quarter)))
    slim = pairs.select("doc_id", "n_chars", "sketch", "next_sketch", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "edited")
    return with_sketch(slim, "edited", "edited_sketch", k, words).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text_of(F.col("sketch")).alias("fingerprint"),
        text_of(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("shingles"),
    )
