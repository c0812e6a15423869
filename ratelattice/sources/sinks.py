"""Writing results: log and audit appends, matrix exports, JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_change_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def append_audit(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def export_matrix(matrix: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The long matrix, range-partitioned by row so that files follow the sheet from top to bottom."""
    ordered = matrix.repartitionByRange("row_no").sortWithinPartitions("row_no", "col_no")
    writer = ordered.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_json_documents(docs: DataFrame, path: str) -> None:
    """Tree documents as JSON lines in key order, one folder per category."""
    ordered = docs.repartitionByRange("category_id", "key", "segment").sortWithinPartitions("category_id", "key", "segment")
    ordered.select("category_id", "doc").write.mode("overwrite").partitionBy("category_id").text(path)
