"""Applying rate updates as they arrive.

The batch operator runs once per micro-batch.  Everything a micro-batch writes
lies in a folder of its epoch and is overwritten if the epoch is replayed, so
a restarted query leaves each request applied once.  The current entries are a
versioned table: epoch N reads the newest version before N and writes version N.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratelattice.operators import admission, mutations
from ratelattice.schemas import TABLES
from ratelattice.sources.tables import RateTables


class CurrentTables(RateTables):
    """The static tables with the entries of the newest version before ``epoch``."""

    def __init__(self, base: RateTables, state: str, epoch: int):
        super().__init__(base.spark, base.directory)
        self._base = base
        self._state = state
        self._epoch = epoch

    @property
    def rate_entry(self) -> DataFrame:
        if self._epoch == 0:
            return self._base.rate_entry
        return self.spark.read.schema(TABLES["rate_entry"]).parquet(f"{self._state}/version={self._epoch - 1}")

    def __getattr__(self, name: str):
        return getattr(self._base, name)


def apply_epoch(base: RateTables, requests: DataFrame, epoch: int, target: str) -> None:
    """Judges one micro-batch and writes its log rows, audit rows and the next entries version."""
    tables = CurrentTables(base, f"{target}/rate_entry", epoch)
    folder = f"{target}/outcomes/epoch={epoch}"
    admission.update_rate_entries(tables, requests).write.mode("overwrite").parquet(folder)
    outcomes = base.spark.read.parquet(folder)
    log = base.rate_change_log
    if epoch:
        earlier = base.spark.read.schema(TABLES["rate_change_log"] + ", epoch bigint").parquet(f"{target}/rate_change_log")
        log = log.unionByName(earlier.filter(F.col("epoch") < epoch).drop("epoch"))
    admission.change_log_rows(log, updates=outcomes).write.mode("overwrite").parquet(f"{target}/rate_change_log/epoch={epoch}")
    mutations.audit_rows(outcomes, "/rates", "PUT").write.mode("overwrite").parquet(f"{target}/audit_log/epoch={epoch}")
    entries = admission.apply_rate_updates(tables.rate_entry, outcomes)
    entries.write.mode("overwrite").parquet(f"{target}/rate_entry/version={epoch}")


def stream_updates(base: RateTables, requests: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Starts the stream over (req_id, req_ts, rate_entry_id, rate, note, attachment_id) requests."""

    def step(batch: DataFrame, epoch: int) -> None:
        apply_epoch(base, batch, epoch, target)

    return requests.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    schema = "req_id bigint, req_ts timestamp_ntz, rate_entry_id bigint, rate decimal(18,4), note string, attachment_id int"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
