"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches by ascending doc_id.  A batch's keys (hashes of its normalised lines,
one row each with the smallest and largest doc_id) are merge-anti-joined with the runs of the
batches before; keys that no run has are added as a run of their own.  When a level has
``FAN_IN`` runs they are merged into one run of the next level, so a batch meets a number of
runs that is logarithmic in the number of batches.

Runs are tables bucketed and sorted by hash: neither the joins nor the merges shuffle them, and
a batch shuffles one row per distinct line.  Lines that have to go then meet their documents by
joins; the keys with the most lines go by a broadcast whose number of rows is bounded.

Everything is DataFrame functions.  Null and empty texts have one empty line.  Rows that share a
doc_id are one document; those without one come after all others, as one document.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelattice.sources.kept import keep, shared_folder

FAN_IN = 2  # runs of a level that are merged into one of the next
LEAST_CHARS = 10  # code points of a line that can be dropped
HOT_LINES, HOT_KEYS = 10_000, 1 << 18  # a key is hot from so many lines on, and there are so many hot keys at most
HASH = ["h1", "h2"]
NO_ID = (1 << 63) - 1  # stands for a missing doc_id
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lowered."""
    bare = F.btrim(line, F.lit(BLANKS))
    # lower() is quick and right where there are but ASCII characters
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _documents(docs: DataFrame) -> DataFrame:
    """(doc_id, owner, text, row): owner orders the documents, row tells apart the texts of one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("owner"), "text", F.xxhash64("text").alias("row"))


def lines(rows: DataFrame) -> DataFrame:
    """(owner, row, at, h1, h2) of every line that is long enough; two 64-bit hashes with seeds of their own."""
    cut = rows.select("owner", "row", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    keyed = cut.select("owner", "row", "at", line_key(F.col("line")).alias("key")).filter(F.length("key") >= LEAST_CHARS)
    return keyed.select("owner", "row", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


class LineRuns:
    """Runs of the line hashes seen so far, by level; each is a bucketed, sorted table."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"
        self.levels: list[list[DataFrame]] = []
        self.names: list[str] = []

    def _written(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows.write.format("parquet").bucketBy(buckets, *HASH).sortBy(*HASH).option("path", f"{self.folder}/{name}").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def add(self, batch: DataFrame) -> DataFrame:
        """Takes in a batch of ``lines`` whose owners follow those of all batches before.

        Gives (h1, h2, first, last, n, seen) per key of the batch: its smallest and largest owner, its lines, and whether a run has it.
        """
        self._compact()
        keys = batch.groupBy(*HASH).agg(F.min("owner").alias("first"), F.max("owner").alias("last"), F.count(F.lit(1)).alias("n"))
        seen = F.lit(False)
        for i, run in enumerate(r for level in self.levels for r in level):
            keys = keys.join(run.select(*HASH, F.lit(True).alias(f"__in{i}")).hint("merge"), HASH, "left")
            seen = seen | F.col(f"__in{i}").isNotNull()
        judged = self._written(keys.select(*HASH, "first", "last", "n", seen.alias("seen")))
        self.levels = self.levels or [[]]
        self.levels[0].append(judged.filter("not seen").select(*HASH))
        return judged

    def _compact(self) -> None:
        """Merges the runs of every full level; their keys differ, so a full merge join is their sorted union."""
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= FAN_IN:
                merged = reduce(lambda one, other: one.join(other.hint("merge"), HASH, "full"), self.levels[level])
                self.levels[level] = []
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._written(merged))

    def close(self) -> None:
        """Takes the tables out of the catalogue; whatever is still to be read has to be kept before."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = []


def repeated_lines(rows: DataFrame, batches: int = 4) -> DataFrame:
    """(owner, row, at) of the lines to drop: all but those of the first document with their key."""
    spark = rows.sparkSession
    owners = rows.agg(F.percentile_approx("owner", [i / batches for i in range(1, batches)], 10_000)).first()[0] if batches > 1 else None
    bounds = sorted(set(owners or []))
    batch = reduce(lambda sofar, b: sofar + (F.col("owner") > b).cast("int"), bounds, F.lit(0))
    folder = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}/lines"
    lines(rows).withColumn("batch", batch).write.partitionBy("batch").parquet(folder)
    schema = "owner bigint, row bigint, at int, h1 bigint, h2 bigint, batch int"
    cut = spark.read.schema(schema).parquet(folder)

    runs = LineRuns(spark)
    repeated = []
    for number in range(len(bounds) + 1):
        judged = runs.add(cut.filter(F.col("batch") == number).drop("batch"))
        # a key that a run has goes everywhere; another stays in the first document of the batch
        first = F.when(~F.col("seen"), F.col("first"))
        found = judged.filter("seen or first < last").select(F.lit(number).alias("batch"), *HASH, first.alias("first"), "n")
        repeated.append(found)
    repeated = keep(reduce(DataFrame.unionByName, repeated), "repeated")
    runs.close()

    total = cut.agg(F.count(F.lit(1))).first()[0]
    hot = F.col("n") >= max(HOT_LINES, -(-total // HOT_KEYS))  # hence at most HOT_KEYS keys
    same = ["batch", *HASH]
    goes = F.col("first").isNull() | (F.col("owner") > F.col("first"))
    hot_keys = repeated.filter(hot).select(*same, "first", F.lit(True).alias("__hot"))
    marked = cut.join(F.broadcast(hot_keys), same, "left")
    of_hot = marked.filter(F.col("__hot") & goes).select("owner", "row", "at")
    rest = marked.filter(F.col("__hot").isNull()).drop("__hot", "first")
    of_rest = rest.join(repeated.filter(~hot).select(*same, "first").hint("merge"), same).filter(goes).select("owner", "row", "at")
    return of_hot.unionByName(of_rest)


def _barrier(df: DataFrame, column: str) -> DataFrame:
    """Computes a column once, before whatever reads it inside lambda functions."""
    return df.withColumn(column, F.explode(F.array(column)))


def drop_repeated_lines(docs: DataFrame, batches: int = 4) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_lines, n_dropped, text without the dropped lines."""
    rows = _documents(docs)
    dropped = repeated_lines(rows, batches).groupBy("owner", "row").agg(F.array_sort(F.collect_set("at")).alias("gone"))
    held = rows.join(dropped.hint("merge"), ["owner", "row"], "left")
    held = _barrier(held.withColumn("__lines", F.split("text", "\n", -1)), "__lines")
    held = held.withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    # the stretches between dropped lines: from the one after a dropped line up to the next
    begins = F.concat(F.array(F.lit(-1)), F.col("gone"))
    stretch = lambda b, i: F.slice(F.col("__lines"), b + 2, F.coalesce(F.get(F.col("gone"), i), F.size("__lines")) - b - 1)
    stays = F.array_join(F.flatten(F.transform(begins, stretch)), "\n")
    text = F.when(F.size("gone") == 0, F.col("text")).otherwise(stays)
    return held.select("doc_id", F.size("__lines").cast("bigint").alias("n_lines"), F.size("gone").cast("bigint").alias("n_dropped"), text.alias("text"))
