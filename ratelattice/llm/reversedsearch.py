"""Reversed ranked search: the items are indexed and the documents stream through the index.

The items' terms form an inverted index that is broadcast in blocks of a bounded number of
postings.  One pass over the documents counts each document's terms of the block (its term
counts are written), from which N, L and the document frequencies follow; a second pass streams
the counts through the index and updates one heap of ``k`` documents per item and task.  The
tasks' heaps are merged by a window.  No (document, item) pair leaves its task otherwise.

Terms are the maximal runs of letters, digits and everything beyond ASCII; only A-Z are lowered.
Null texts have no terms.  Items without terms, or that no document matches, give no rows.
Repeated items and repeated documents are rows of their own; documents without a doc_id count
like others and come last among equal scores.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelattice.llm.common import Heaps
from ratelattice.skew import running_total
from ratelattice.sources.kept import keep, shared_folder

POSTINGS, LEAST_ITEM = 1_000_000, 50  # postings of a block; an item counts as so many at least
CELLS = 1 << 20  # scores held at once
NO_ID = np.iinfo(np.int64).max  # stands for a missing doc_id, so it comes last
EXACT = 1 << 53  # sums below are exact in doubles
TABLE = bytes.maketrans(
    bytes(range(128)),
    bytes(c if chr(c).isalnum() else 32 for c in bytes(range(128)).lower()),
)


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """(1000000000 tf) div (1000 tf + 8 m)."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def lengths(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """m: 100 - 90 + (90 n N) div L, for n terms, N documents and L terms of all documents."""
    if len(n) and 90 * int(n.max()) * documents > np.iinfo(np.int64).max:
        return np.array([10 + 90 * int(x) * documents // length for x in n], dtype=np.int64)
    return 10 + 90 * n * documents // length


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Index:
    """Postings of a block of items: the items of term t are items[starts[t] : starts[t + 1]]."""

    def __init__(self, terms: list[list[bytes]]):
        self.number: dict[bytes, int] = {}
        owners: list[list[int]] = []
        for item, found in enumerate(terms):
            for term in found:
                place = self.number.setdefault(term, len(self.number))
                if place == len(owners):
                    owners.append([])
                owners[place].append(item)
        self.count = len(terms)
        self.longest = max((len(t) for t in terms), default=0)
        self.starts = np.cumsum([0, *(len(o) for o in owners)])
        self.items = np.array([i for o in owners for i in o], dtype=np.int64)
        self.weights = np.zeros(len(owners), dtype=np.int64)

    def scores(self, docs: int, doc: np.ndarray, term: np.ndarray, value: np.ndarray) -> np.ndarray:
        """(docs x items) sums of ``value`` * weight over the terms of each document."""
        reach = self.starts[term + 1] - self.starts[term]
        entry = np.repeat(np.arange(len(term)), reach)
        place = self.starts[term][entry] + np.arange(len(entry)) - np.repeat(np.cumsum(reach) - reach, reach)
        cell = doc[entry] * self.count + self.items[place]
        amount = (value * self.weights[term])[entry]
        if self.longest * 1_000_000 * int(self.weights.max(initial=0)) < EXACT:
            total = np.bincount(cell, weights=amount, minlength=docs * self.count).astype(np.int64)
        else:
            total = np.zeros(docs * self.count, dtype=np.int64)
            np.add.at(total, cell, amount)
        return total.reshape(docs, self.count)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])


def _count_terms(sent) -> Callable:
    """Per document: doc_id, its number of terms, and the index's terms in it with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = cloudpickle.loads(sent.value).number
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                n, terms, counts = [], [], []
                for text in part.column(1).to_pylist():
                    words = terms_of(text)
                    found = Counter(filter(None.__ne__, map(number.get, words)))
                    n.append(len(words))
                    terms.append(list(found))
                    counts.append(list(found.values()))
                yield pa.record_batch(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                    names=["doc_id", "n", "terms", "counts"],
                )

    return run


def _best(sent, k: int, documents: int, length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = cloudpickle.loads(sent.value)
        heaps = Heaps(index.count, k, np.ones(index.count, dtype=np.int64))  # scores above 0 only
        step = max(1, CELLS // max(1, index.count))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                ids = part.column(0).fill_null(NO_ID).to_numpy()
                m = lengths(part.column(1).to_numpy(), documents, max(1, length))
                doc = np.repeat(np.arange(len(ids)), part.column(2).value_lengths().to_numpy())
                term = part.column(2).flatten().to_numpy().astype(np.int64)
                value = impacts(part.column(3).flatten().to_numpy(), m[doc])
                scores = index.scores(len(ids), doc, term, value)
                d, item = np.nonzero(scores >= heaps.least[None, :])
                heaps.offer(item, scores[d, item], ids[d])
        items, scores, ids = heaps.settle()
        yield pa.record_batch(
            [pa.array(items, pa.int64()), pa.array(scores, pa.int64()), pa.array(ids, pa.int64(), mask=ids == NO_ID)], names=["item", "score", "doc_id"]
        )

    return run


def reversed_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents (doc_id, text) of each item (item_id, text): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    schema = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id bigint, score bigint"
    worded = items.select("item_id", F.col("text").cast("string").cast("binary").alias("text"))
    worded = worded.mapInArrow(_item_terms, f"item_id {items.schema['item_id'].dataType.simpleString()}, terms array<binary>").filter("size(terms) > 0")
    worded = keep(worded.withColumn("hash", F.xxhash64("terms")), "items")
    cost = F.greatest(F.size("terms"), F.lit(LEAST_ITEM))
    numbered = running_total(worded, [], ["item_id", "hash"], "__before", cost)
    numbered = keep(numbered.select(F.floor(F.col("__before") / POSTINGS).cast("int").alias("block"), "item_id", "terms"), "blocks")

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    folder = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}/best"
    blocks = [r["block"] for r in numbered.select("block").distinct().orderBy("block").collect()]
    for number in blocks:
        held = numbered.filter(F.col("block") == number).collect()  # a block of bounded size
        index = Index([[bytes(t) for t in r["terms"]] for r in held])
        sent = spark.sparkContext.broadcast(cloudpickle.dumps(index))
        counted = keep(texts.mapInArrow(_count_terms(sent), "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"), "counts")
        documents, length = counted.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        frequency = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # the block's terms
        for row in frequency:
            index.weights[row["term"]] = weight(documents, row["count"])
        sent = spark.sparkContext.broadcast(cloudpickle.dumps(index))
        best = counted.filter("size(terms) > 0").mapInArrow(_best(sent, k, documents, length), "item bigint, score bigint, doc_id bigint")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        named = numbered.sparkSession.createDataFrame([(i, r["item_id"]) for i, r in enumerate(held)], f"item bigint, {schema.split(',')[0]}")
        best.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score").write.parquet(f"{folder}/block={number}")
    if not blocks:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/block=*")
