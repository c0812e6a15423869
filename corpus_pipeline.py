"""From raw documents to packed sequences: each stage keeps what it returns, the next works on that.

A stage takes (spark, docs, sf_dir) and returns rows with the columns of ``docs``; the last one
returns pieces.  Rows are told apart by doc_id and text, so repeated rows, and rows that
share a doc_id or have none, are each decided on.  Null texts count as empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelattice.llm import packing, pivotal, quotientfilter, setsketch, toxicity
from ratelattice.llm.common import table
from ratelattice.llm.queries import tokenizer_path
from ratelattice.skew import running_total
from ratelattice.sources.kept import keep, shared_folder

REJECTED_FROM = 0.5


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _ranked(rows: DataFrame, *keys: str) -> DataFrame:
    """Adds __nth: 1, 2 ... among rows of equal keys, by source and language."""
    return rows.withColumn("__nth", F.row_number().over(Window.partitionBy(*keys).orderBy("source", "lang", "n_chars")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5 stay; labels are learned from the rows meant for it, as in the query."""
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    index = toxicity.fit(docs, labels)
    return toxicity.score_texts(docs, index, docs.columns).filter(F.col("score") < REJECTED_FROM).select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    stays = quotientfilter.exact_duplicates(docs).filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    normal = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]", "")
    hashed = docs.withColumn("__of", F.sha2(F.encode(normal, "UTF-8"), 256))
    met = hashed.join(stays.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__sha")))
    longest = Window.partitionBy("__id", "__sha").orderBy(F.desc(F.char_length("text")), "source", "lang")
    return met.withColumn("__nth", F.row_number().over(longest)).filter("__nth = 1").select(_columns(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, resemblance 0.8 or more."""
    of = F.unhex(F.sha2(F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8"), 256))
    hashed = docs.withColumn("__of", of)
    # rows are known by doc_id and text: numbered in that order, so the smallest doc_id stays, those without one last
    keys = hashed.select(F.col("doc_id").isNull().alias("__none"), F.col("doc_id").alias("__doc"), F.col("__of").alias("__sha")).distinct()
    ids = keep(running_total(keys, [], ["__none", "__doc", "__sha"], "__id"), "row_ids").drop("__none")
    met = hashed.join(ids.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__of") == F.col("__sha")))
    met = keep(met.select(*_columns(docs), "__id"), "numbered")
    found = setsketch.near_duplicates(met.select(F.col("__id").alias("doc_id"), "text"), words=5, num=80, den=100)
    stays = found.filter("kept").select(F.col("doc_id").alias("__stays")).distinct()
    left = met.join(stays.hint("merge"), F.col("__id") == F.col("__stays"))
    return _ranked(left, "__id").filter("__nth = 1").select(_columns(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to three times."""
    taken = pivotal.mix(docs).groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.sort_array(F.collect_list("copies"), asc=False).alias("__copies"))
    taken = taken.filter(F.get("__copies", F.lit(0)) > 0)
    hashed = docs.withColumn("__of", F.xxhash64(F.col("text").cast("string")))
    met = hashed.join(taken.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__hash")))
    nth = _ranked(met, "__id", "__hash").withColumn("__n", F.get("__copies", F.col("__nth") - 1)).filter("__n > 0")
    return nth.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n")))).select(_columns(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids."""
    return packing.pack_documents(docs, tokenizer_path(), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # SQL can't express the classifier, the sketches and the random rounding


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
