"""Reading rate entries from positional sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelattice.functions.scalars import not_blank, parse_timestamp
from ratelattice.schemas import RATE

CELLS = "c0 string, c1 string, c2 string, c3 string, c4 string, c5 string, c6 string, c7 string, c8 string"


WHOLE = {"id": "bigint", "l2_id": "int", "l3_id": "bigint", "product_line_id": "bigint", "override": "int"}
PLACES = {"id": "c0", "created_on": "c1", "l2_id": "c4", "l3_id": "c5", "product_line_id": "c6", "rate": "c7", "override": "c8"}
NEEDED = ("id", "rate")


def _number(name: str) -> Column:
    # sheets may render whole numbers with a decimal point
    return F.col(PLACES[name]).try_cast("decimal(20,4)")


def _whole(name: str) -> Column:
    return _number(name).try_cast(WHOLE[name])


def _entries(cells: DataFrame) -> DataFrame:
    return cells.select(
        _whole("id").alias("id"),
        parse_timestamp(F.col("c1")).alias("created_on"),
        F.col("c2").alias("created_by"),
        F.col("c3").alias("note"),
        F.coalesce(_whole("override"), _whole("l2_id")).alias("l2_id"),
        _whole("l3_id").alias("l3_id"),
        _whole("product_line_id").alias("product_line_id"),
        F.col("c7").try_cast(RATE).alias("rate"),
    )


def _rejects(cells: DataFrame) -> DataFrame:
    """(line, cell, value, reason) for every cell that cannot be taken over as it is, and for rows of a wrong length."""

    def failed(cell: str, value: Column, reason: Column) -> Column:
        return F.when(reason.isNotNull(), F.struct(F.lit(cell).alias("cell"), value.alias("value"), reason.alias("reason")))

    # cells of a row that has not nine; eight are enough
    count = F.size(F.split(F.regexp_replace("broken", r'"[^"]*"', ""), ","))
    found = [failed("row", F.lit(None).cast("string"), F.when(count < 8, "SHORT_ROW").when(count > 9, "LONG_ROW"))]
    for name, place in PLACES.items():
        value = F.col(place)
        given = not_blank(value)
        if name == "created_on":
            reason = F.when(given & parse_timestamp(value).isNull(), "BAD_DATE")
        elif name == "rate":
            reason = F.when(given & value.try_cast(RATE).isNull(), "BAD_NUMBER")
        else:
            exact = F.coalesce(_whole(name).cast("decimal(20,4)") == _number(name), F.lit(False))
            reason = F.when(given & ~exact, "BAD_NUMBER")
        if name in NEEDED:
            reason = F.coalesce(reason, F.when(~F.coalesce(given, F.lit(False)) & F.col("broken").isNull(), "MISSING"))
        found.append(failed(place, value, reason))
    return cells.select("line", F.explode(F.array_compact(F.array(*found))).alias("r")).select("line", "r.*")


def read_rate_sheet(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """Rate entries of a CSV sheet with a header row; a ninth cell replaces the fifth.

    ``line_breaks`` allows quoted line breaks inside cells; a file is then read by one task.
    """
    return _entries(spark.read.schema(CELLS).csv(path, header=True, enforceSchema=True, multiLine=line_breaks))


def read_rate_sheet_rejects(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """What ``read_rate_sheet`` leaves empty or drops, and why: (line, cell, value, reason)."""
    read = spark.read.schema(f"{CELLS}, broken string").option("columnNameOfCorruptRecord", "broken")
    cells = read.csv(path, header=True, enforceSchema=True, multiLine=line_breaks)
    return _rejects(cells.withColumn("line", F.coalesce("broken", F.concat_ws(",", *[F.coalesce(f"c{i}", F.lit("")) for i in range(9)]))))


def parse_rate_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """The same for sheet rows held as text."""
    return _entries(lines.select(F.from_csv(column, F.lit(CELLS)).alias("r")).select("r.*"))


def rate_line_rejects(lines: DataFrame, column: str = "line") -> DataFrame:
    """What ``parse_rate_lines`` leaves empty or drops, and why."""
    parsed = F.from_csv(column, F.lit(f"{CELLS}, broken string"), {"columnNameOfCorruptRecord": "broken"})
    return _rejects(lines.select(F.col(column).alias("line"), parsed.alias("r")).select("line", "r.*"))
