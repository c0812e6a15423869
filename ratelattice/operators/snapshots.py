"""As-of rates from snapshots: one snapshot and the months after it instead of the whole log.

A store is a folder with the change log partitioned by month (``log/month=...``) and snapshots
(``snapshots/at=.../version=...``), each the last change of every entry before the first
moment of a month.  A snapshot is made from the one before it and the months between, so
keeping them current reads each month once.  A moment reads the newest snapshot that is not after
its month, and the months from there on; the rest is pruned by the partition column.

Changes may come late.  ``append_changes`` adds rows to the log and merges those before a snapshot
into a new version of it; the newest version that was written to its end counts, so a lost
run leaves the old one in force.  Late changes are seen once ``append_changes`` returns.
Changes without a moment lie in the log and never count, as in ``rate_asof``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelattice.operators.history import ORDER, moment
from ratelattice.schemas import TABLES, fields

LOG = TABLES["rate_change_log"]
LAST = ["rate_entry_id", "rate", "created_on", "id"]


def _month() -> Column:
    return F.trunc(F.col("created_on").cast("date"), "month")


def _last(changes: DataFrame) -> DataFrame:
    """Last change of every entry, reduced in each map task before the shuffle."""
    last = F.max_by(F.struct("rate", "created_on", "id"), F.struct(*ORDER))
    return changes.groupBy("rate_entry_id").agg(last.alias("last")).select("rate_entry_id", "last.*")


def _add_to_log(changes: DataFrame, folder: str, mode: str) -> None:
    # a month, or an entry, may hold most of the log: rows are spread over the files by log id
    spread = changes.withColumn("month", _month()).repartition("month", F.pmod(F.xxhash64("id"), F.lit(64)))
    spread.write.mode(mode).partitionBy("month").parquet(f"{folder}/log")


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{LOG}, month date").parquet(f"{folder}/log")


def snapshots(spark: SparkSession, folder: str) -> dict[date, int]:
    """Moment and newest complete version of every snapshot, from the folder's names."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/snapshots/at=*/version=*/_SUCCESS")
    found: dict[date, int] = {}
    for status in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or ():
        version = status.getPath().getParent()
        at = date.fromisoformat(version.getParent().getName().removeprefix("at="))
        found[at] = max(found.get(at, 0), int(version.getName().removeprefix("version=")))
    return dict(sorted(found.items()))


def _read(spark: SparkSession, folder: str, at: date, version: int) -> DataFrame:
    kinds = dict(fields("rate_change_log"))
    schema = ", ".join(f"{c} {kinds[c]}" for c in LAST)
    return spark.read.schema(schema).parquet(f"{folder}/snapshots/at={at}/version={version}")


def _until(spark: SparkSession, folder: str, before: date, known: dict[date, int]) -> DataFrame:
    """Changes that decide the rates before ``before``: the newest snapshot up to it and the months from there."""
    base = max((at for at in known if at <= before), default=None)
    log = read_log(spark, folder).filter(F.col("month") < F.lit(before))
    if base is None:
        return log.select(*LAST)
    return _read(spark, folder, base, known[base]).unionByName(log.filter(F.col("month") >= F.lit(base)).select(*LAST))


def take_snapshots(spark: SparkSession, folder: str, months: Sequence[date]) -> None:
    """Makes the snapshots at the first days ``months`` that the store does not have yet."""
    if any(at.day != 1 for at in months):
        raise ValueError("a snapshot is taken at the first day of a month")
    known = snapshots(spark, folder)
    for at in sorted(set(months) - set(known)):
        _last(_until(spark, folder, at, known)).write.parquet(f"{folder}/snapshots/at={at}/version=1", mode="overwrite")
        known[at] = 1


def create_store(log: DataFrame, folder: str, months: Sequence[date] = ()) -> None:
    """Writes ``log`` as a new store and takes its snapshots."""
    _add_to_log(log, folder, "errorifexists")
    take_snapshots(log.sparkSession, folder, months)


def append_changes(changes: DataFrame, folder: str) -> None:
    """Adds changes (stored, as they are read several times), late ones included."""
    spark = changes.sparkSession
    _add_to_log(changes, folder, "append")
    earliest = changes.agg(F.min("created_on").alias("m")).first()["m"]
    for at, version in snapshots(spark, folder).items():
        if earliest is not None and earliest < datetime(at.year, at.month, 1):
            late = changes.filter(_month() < F.lit(at)).select(*LAST)
            merged = _last(_read(spark, folder, at, version).unionByName(late))
            merged.write.parquet(f"{folder}/snapshots/at={at}/version={version + 1}", mode="overwrite")


def rate_asof_stored(spark: SparkSession, folder: str, as_of: str) -> DataFrame:
    """``history.rate_asof`` of the store's log."""
    month = datetime.fromisoformat(as_of).date().replace(day=1)
    before = _until(spark, folder, month, snapshots(spark, folder))
    within = read_log(spark, folder).filter((F.col("month") == F.lit(month)) & (F.col("created_on") <= moment(as_of)))
    return _last(before.unionByName(within.select(*LAST))).select("rate_entry_id", "rate", "created_on")
