"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelattice.operators.components import connected

WHITE_SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected edges (a, b): the smallest node reachable from each node.

    Labels travel along the edges and then to the label of a label, so a round doubles their
    reach; each round writes one table of labels.  The nodes stay in tables throughout.
    Null ends are ignored.
    """
    return connected(stars(edges))


def stars(edges: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the same nodes: each node and its smaller neighbours lead to the smallest of these.

    Nodes that share many neighbours keep few edges, and every round over the edges makes fewer rows.
    """
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    met = down.join(down.groupBy("a").agg(F.min("b").alias("__least")), "a")
    return met.select(F.when(F.col("b") == F.col("__least"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("__least").alias("b")).distinct()


def blocks(df: DataFrame, key: str, member: str, size: str, least: int, most: int, share: int = 16) -> DataFrame:
    """Every two rows of a group meet in some (key, __i, __j); __part tells a row's own part.

    Groups are cut into parts of ``least`` to ``most`` rows (one in ``share`` of the group in
    between), so that no task holds more than two parts of a group.
    """
    part_rows = F.least(F.greatest(F.ceil(F.col(size) / share), F.lit(least)), F.lit(most))
    cut = df.withColumn("__parts", F.ceil(F.col(size) / part_rows).cast("int"))
    cut = cut.withColumn("__part", F.pmod(F.xxhash64(member), "__parts").cast("int"))
    cut = cut.withColumn("__other", F.explode(F.expr("sequence(0, __parts - 1)")))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # not merged by size: small blocks take long
    return cut.select(
        *df.columns,
        "__part",
        F.least("__part", "__other").alias("__i"),
        F.greatest("__part", "__other").alias("__j"),
    ).repartition(parts, key, "__i", "__j").sortWithinPartitions(key, "__i", "__j")


def groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The runs of equal ``keys`` of sorted batches; a run may span batches."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        here = pa.Table.from_batches([batch])
        here = here if rest is None else pa.concat_tables([rest, here]).combine_chunks()
        changes = np.zeros(here.num_rows - 1, dtype=bool)
        for key in keys:
            values = here.column(key).to_numpy()
            changes |= values[1:] != values[:-1]
        starts = [0, *(np.flatnonzero(changes) + 1)]
        for start, end in zip(starts[:-1], starts[1:], strict=True):
            yield here.slice(start, end - start)
        rest = here.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest


class Packed:
    """A value to broadcast: each worker unpacks it once for all its tasks, without having this package, and keeps no packed copy."""

    def __init__(self, held):
        self.held = held

    def __reduce__(self):
        return cloudpickle.loads, (cloudpickle.dumps(self.held),)


class Heaps:
    """The ``k`` first (highest score, then smallest id) offers of each of ``n`` rows; memory stays in proportion to n * k."""

    def __init__(self, n: int, k: int, least: np.ndarray | None = None):
        self.n, self.k = n, k
        self.least = np.full(n, np.iinfo(np.int64).min) if least is None else least.copy()  # no lower score can enter
        self.kept = [np.empty(0, dtype=np.int64) for _ in range(3)]
        self.waiting: list[list[np.ndarray]] = []
        self.waits = 0

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        enter = scores >= self.least[rows]
        self.waiting.append([rows[enter], scores[enter], ids[enter]])
        self.waits += int(enter.sum())
        if self.waits > max(1 << 16, self.n * self.k):
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, scores, ids) kept so far, in order."""
        rows, scores, ids = (np.concatenate([self.kept[c], *[w[c] for w in self.waiting]]) for c in range(3))
        order = np.lexsort((ids, -scores, rows))
        rows, scores, ids = rows[order], scores[order], ids[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        first = place < self.k
        full = place == self.k - 1
        self.least[rows[full]] = np.maximum(self.least[rows[full]], scores[full])
        self.kept, self.waiting, self.waits = [rows[first], scores[first], ids[first]], [], 0
        return tuple(self.kept)


class Forest:
    """Union by smaller root over the positions of one block of rows."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def union(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j
