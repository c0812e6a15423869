"""The historic rate matrix: tree nodes down, product lines across."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelattice.functions.scalars import rate_text, strip_quotes
from ratelattice.operators.hierarchy import column_axis, row_axis
from ratelattice.operators.history import DEFAULT_AS_OF, rate_asof
from ratelattice.operators.lookups import entry_cells
from ratelattice.sources.kept import keep
from ratelattice.sources.tables import RateTables


def rate_matrix_asof(tables: RateTables, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """Every existing cell of the matrix with its rate at ``as_of``.

    Starts from the entries, so a (node, product line) pair without an entry
    costs nothing; a cell whose entry has no change by then is empty text.
    The hierarchy and its active flags are the current ones.
    """
    rows = row_axis(tables).filter("level >= 2").select("level", F.col("id").alias("node_id"), F.col("position").alias("row_no"))
    columns = column_axis(tables).select(F.col("id").alias("product_line_id"), F.col("position").alias("col_no"))
    cells = entry_cells(tables.rate_entry).drop("rate").join(rows, ["level", "node_id"]).join(columns, "product_line_id")
    rates = rate_asof(tables.rate_change_log, as_of).select("rate_entry_id", "rate")
    return cells.join(rates, "rate_entry_id", "left").select(
        "row_no", "col_no", "level", "node_id", "product_line_id", rate_text(F.col("rate")).alias("rate")
    )


def matrix_sheet(matrix: DataFrame, width: int = 8) -> DataFrame:
    """Wide form of the matrix in bands of ``width`` columns: c1 of band b is matrix column b * width + 1.

    A band without cells of a row has no row of its own.
    """
    slot = (F.col("col_no") - 1) % width
    columns = [F.max(F.when(slot == i, F.col("rate"))).alias(f"c{i + 1}") for i in range(width)]
    return matrix.groupBy("row_no", F.floor((F.col("col_no") - 1) / width).alias("band")).agg(*columns)


HEADER = {0: "", 1: "", 2: "", 3: "Base rates"}  # rows above the matrix: categories, sub-categories, codes, base rates


def labelled_sheet(tables: RateTables, as_of: str = DEFAULT_AS_OF, width: int = 8) -> DataFrame:
    """The whole sheet in bands: (row_no, band, label, c1 ...), header rows first, then every tree row.

    Names of categories and sub-categories stand in the first column that they span.  Band 0
    has every row; other bands have the rows with something in them.
    """
    spark = tables.business_category.sparkSession
    lines = tables.product_line.select("id", "base_rate", F.col("business_sub_category_id").alias("sub_id"))
    subs = tables.business_sub_category.select(F.col("id").alias("sub_id"), F.col("name").alias("sub"), F.col("business_category_id").alias("category_id"))
    categories = tables.business_category.select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    columns = column_axis(tables).join(lines, "id").join(subs, "sub_id").join(categories, "category_id")
    columns = keep(columns, "columns")

    def cells(row_no: int, value: Column, col_no: Column = F.col("position")) -> list[Column]:
        return [F.lit(row_no).cast("bigint").alias("row_no"), col_no.alias("col_no"), value.alias("rate")]

    spans = [columns.groupBy(f"{name}_id", name).agg(F.min("position").alias("position")).select(*cells(i, strip_quotes(F.col(name)))) for i, name in enumerate(("category", "sub"))]
    codes = columns.select(*cells(2, strip_quotes(F.col("label"))))
    base = columns.select(*cells(3, rate_text(F.col("base_rate"))))
    header = spark.createDataFrame(list(HEADER.items()), "row_no bigint, label string")
    labels = keep(row_axis(tables).select(F.col("position").alias("row_no"), "label").unionByName(header), "labels")
    empty = labels.select("row_no", F.lit(1).cast("bigint").alias("col_no"), F.lit(None).cast("string").alias("rate"))
    matrix = rate_matrix_asof(tables, as_of).select("row_no", "col_no", "rate")
    whole = reduce(DataFrame.unionByName, [*spans, codes, base, matrix, empty])
    return matrix_sheet(whole, width).join(labels, "row_no")
