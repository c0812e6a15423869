"""Intermediate tables written to the cluster's shared folder.

A written table cuts the lineage: what reads it several times computes its
input once, and a lost executor costs only the tasks at hand.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PORTION_BYTES = "ratelattice.kept.portionBytes"
DEFAULT_PORTION = 256 << 20  # of input files
MOST_PORTIONS = 16
UNKNOWN_BYTES = 1 << 60  # Spark's guess for rows that are not in files


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder where it is unset and the master is local, as in tests.

    On a cluster there is no fallback: executors would each write to a disk of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="ratelattice-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


_SCOPES: list[list[str]] = []


def _folder(spark: SparkSession, lasting: bool = False) -> str:
    folder = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"
    if _SCOPES and not lasting:
        _SCOPES[-1].append(folder)
    return folder


def keep(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """``lasting``: kept for the session, even if a scope happens to be open."""
    folder = _folder(df.sparkSession, lasting)
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside are removed once it is written, not when the driver's garbage is collected."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)


def keep_tidy(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """``keep`` for large tables: closely packed, and without the shuffle files below."""
    return _written(df, f"{_folder(df.sparkSession, lasting)}/{name}")


def _written(df: DataFrame, path: str, by: Sequence[str] = ()) -> DataFrame:
    with _tidy(df.sparkSession):
        df.write.partitionBy(*by).parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def portions(spark: SparkSession, size: int | None) -> int:
    """In how many portions a table of ``size`` bytes is worked on; each reads the input again, so their number stays bounded."""
    if size is None or size >= UNKNOWN_BYTES:
        return 1
    return min(MOST_PORTIONS, max(1, -(-size // int(spark.conf.get(PORTION_BYTES, str(DEFAULT_PORTION))))))


def portion_of(key: Column, of: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(of)).cast("int")


def portion(df: DataFrame, key: Column, number: int, of: int) -> DataFrame:
    """The rows of one of ``of`` portions; those with equal keys, nulls too, are in the same."""
    return df if of == 1 else df.filter(portion_of(key, of) == number)


def by_portion(spark: SparkSession, of: int, make: Callable[[int], DataFrame], name: str, by: Sequence[str] = ()) -> DataFrame:
    """The rows of ``make(number)`` for all portions, each kept before the next one starts.

    What a portion shuffles and keeps is removed at its end, so the disk holds that of one portion
    and the results.  A single portion is not kept, as nothing follows it.
    """
    if of == 1:
        return make(0)
    done = []
    for number in range(of):
        path = f"{_folder(spark)}/{name}"
        with scope(spark):
            done.append(_written(make(number), path, by))
    return reduce(DataFrame.unionByName, done)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables kept inside are removed at the end, so what is built on them has to be written before.

    Without a scope they stay, as a result may be read at any time.
    """
    folders: list[str] = []
    _SCOPES.append(folders)
    try:
        yield
    finally:
        _SCOPES.remove(folders)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
