"""Keyed reads of the tables, for whole tables or frames of ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelattice.sources.tables import RateTables

NODE_TABLES = {0: "group_node", 1: "node_l1", 2: "node_l2", 3: "node_l3"}


def category_names(categories: DataFrame) -> DataFrame:
    return categories.select("name")


def category_options(categories: DataFrame) -> DataFrame:
    """All categories, inactive ones included, as (id, label)."""
    return categories.select("id", F.col("name").alias("label"))


def lookup_missing(table: DataFrame, ids: DataFrame, what: str, id_column: str = "requested_id") -> DataFrame:
    """Requested ids the table does not hold, each with its error text."""
    missing = ids.join(table.select("id"), F.col(id_column) == F.col("id"), "left_anti")
    return missing.select(
        id_column, F.concat(F.lit(f"{what} not found for id : "), F.col(id_column)).alias("error")
    )


def sub_categories_by_category(sub_categories: DataFrame) -> DataFrame:
    """Active and inactive alike; filter on business_category_id for one category."""
    return sub_categories.select("business_category_id", "id", "name", "is_active")


def active_product_lines(product_lines: DataFrame) -> DataFrame:
    return product_lines.filter("is_active = 1").select("business_sub_category_id", "id", "code", "base_rate")


def resolve_codes(product_lines: DataFrame, codes: DataFrame) -> DataFrame:
    """Product line and sub-category of each requested code; unknown codes keep nulls."""
    known = product_lines.select(
        F.col("code").alias("__code"), F.col("id").alias("product_line_id"), "business_sub_category_id"
    )
    return codes.join(known, codes["code"] == known["__code"], "left").drop("__code")


def color_by_quarter(colors: DataFrame, quarter: str | None = None) -> DataFrame:
    df = colors.select("fy_quarter", "id", "code", "name")
    return df if quarter is None else df.filter(F.col("fy_quarter") == quarter)


def colors_of(colors: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` with the colour of its ``fy_quarter``: color_id, code, name, null where there is none."""
    known = colors.select("fy_quarter", F.col("id").alias("color_id"), "code", "name")
    return asked.join(known, "fy_quarter", "left")


def all_nodes(tables: RateTables) -> DataFrame:
    """The four node tables as one: (level, id, parent_id, name, is_active)."""
    parts = []
    for level, name in NODE_TABLES.items():
        parent = "business_category_id" if level == 0 else "parent_id"
        parts.append(
            getattr(tables, name).select(
                F.lit(level).alias("level"),
                F.col("id").cast("bigint").alias("id"),
                F.col(parent).cast("bigint").alias("parent_id"),
                "name",
                F.col("is_active").cast("int").alias("is_active"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def nodes_by_name(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Nodes with the wanted (level, parent_id, name), whatever their state."""
    return wanted.join(nodes, ["level", "parent_id", "name"]).select("level", "parent_id", "name", "id", "is_active")


def l2_children(level3: DataFrame) -> DataFrame:
    return level3.select(F.col("parent_id").alias("l2_id"), F.col("id").alias("l3_id"))


def entry_cells(entries: DataFrame, *extra: str) -> DataFrame:
    """Entries by the node they sit on; an entry naming both levels appears on both.

    One pass over the entries, and no null node ids left to pile up in a join.
    """
    sides = F.array(
        F.struct(F.lit(2).alias("level"), F.col("l2_id").cast("bigint").alias("node_id")),
        F.struct(F.lit(3).alias("level"), F.col("l3_id").cast("bigint").alias("node_id")),
    )
    return entries.select(
        F.col("id").alias("rate_entry_id"), "product_line_id", "rate", *extra, F.inline(sides)
    ).filter("node_id IS NOT NULL")


def entries_by_node(entries: DataFrame) -> DataFrame:
    return entry_cells(entries).select("level", "node_id", "rate_entry_id", "product_line_id", "rate")


def cell_rate(entries: DataFrame) -> DataFrame:
    """Rate of every (level-2 node, product line) cell."""
    return entries.filter("l2_id IS NOT NULL").select("l2_id", "product_line_id", "rate")


def product_line_detail(tables: RateTables) -> DataFrame:
    """Product lines with their color and their first rate entry."""
    first = tables.rate_entry.groupBy("product_line_id").agg(F.min("id").alias("rate_entry_id"))
    colors = tables.color_code.select(
        F.col("id").alias("color_id"), F.col("code").alias("color_code"), F.col("name").alias("color_name")
    )
    lines = tables.product_line
    return (
        lines.join(colors, lines["color_code_id"] == colors["color_id"], "left")
        .join(first, lines["id"] == first["product_line_id"], "left")
        .select("id", "code", "base_rate", "color_code", "color_name", "rate_entry_id")
    )
