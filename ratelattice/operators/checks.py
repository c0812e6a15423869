"""Rate constraints and request checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelattice.functions.scalars import not_blank
from ratelattice.operators.lookups import entry_cells
from ratelattice.schemas import RATE
from ratelattice.sources.tables import RateTables


def child_entries(tables: RateTables) -> DataFrame:
    """Level-3 entries under their level-2 node, the state of the nodes ignored."""
    parents = tables.node_l3.select(F.col("id").alias("l3_id"), F.col("parent_id").alias("l2_id"))
    entries = tables.rate_entry.filter("l3_id IS NOT NULL").select("l3_id", "product_line_id", "rate")
    return entries.join(parents, "l3_id")


def child_totals(tables: RateTables) -> DataFrame:
    """Sum of the level-3 rates per (level-2 node, product line)."""
    return child_entries(tables).groupBy("l2_id", "product_line_id").agg(F.sum("rate").cast(RATE).alias("child_total"))


def parent_rates(tables: RateTables) -> DataFrame:
    return tables.rate_entry.filter("l2_id IS NOT NULL").select("l2_id", "product_line_id", F.col("rate").alias("l2_rate"))


def child_sum_violations(tables: RateTables) -> DataFrame:
    """Cells whose level-3 rates add up to more than the level-2 rate."""
    return (
        parent_rates(tables)
        .join(child_totals(tables), ["l2_id", "product_line_id"])
        .filter(F.col("child_total") > F.col("l2_rate"))
        .select("l2_id", "product_line_id", "l2_rate", "child_total")
    )


def max_allowed_rate(tables: RateTables) -> DataFrame:
    """Room left for every level-3 rate: parent rate minus what the siblings take."""
    limits = parent_rates(tables).join(child_totals(tables), ["l2_id", "product_line_id"])
    siblings = F.col("child_total") - F.col("rate")
    return child_entries(tables).join(limits, ["l2_id", "product_line_id"]).select(
        "l3_id",
        "product_line_id",
        siblings.cast(RATE).alias("existing_total"),
        (F.col("l2_rate") - siblings).cast(RATE).alias("max_value_allowed"),
    )


def parent_rate_check(tables: RateTables, proposals: DataFrame) -> DataFrame:
    """Whether each proposed level-2 rate covers its children: (rate_entry_id, new_rate)."""
    cells = tables.rate_entry.filter("l2_id IS NOT NULL").select(F.col("id").alias("rate_entry_id"), "l2_id", "product_line_id")
    total = F.coalesce(F.col("child_total"), F.lit(0).cast(RATE))
    return (
        proposals.join(cells, "rate_entry_id")
        .join(child_totals(tables), ["l2_id", "product_line_id"], "left")
        .select("rate_entry_id", "new_rate", total.alias("child_total"), (total <= F.col("new_rate")).alias("ok"))
    )


def duplicate_cells(cells: DataFrame) -> DataFrame:
    """Cells (level, node_id, product_line_id) that occur more than once."""
    return cells.groupBy("level", "node_id", "product_line_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def new_cells_only(entries: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested cells that hold no entry yet."""
    taken = entry_cells(entries).select("level", "node_id", "product_line_id")
    return requested.join(taken, ["level", "node_id", "product_line_id"], "left_anti").select("level", "node_id", "product_line_id")


def first_error(*checks: tuple[Column, str]) -> Column:
    """Text of the first failed check, null when all hold; a null outcome counts as failed."""
    result: Column | None = None
    for holds, text in checks:
        failed = ~F.coalesce(holds, F.lit(False))
        result = F.when(failed, text) if result is None else result.when(failed, text)
    return result


def add_line_error() -> Column:
    return first_error(
        (not_blank(F.col("code")), "CODE_BLANK"),
        (F.col("business_sub_category_id").isNotNull(), "SUB_CATEGORY_MISSING"),
        (F.col("base_rate").isNotNull(), "RATE_MISSING"),
        (F.col("base_rate") >= 0, "RATE_NEGATIVE"),
    )


def patch_line_error() -> Column:
    return first_error(
        (F.col("base_rate").isNull() | (F.col("base_rate") >= 0), "RATE_NEGATIVE"),
        (F.col("code").isNotNull() | F.col("base_rate").isNotNull(), "NOTHING_TO_CHANGE"),
    )


def rate_error(with_note: bool) -> Column:
    checks = [(F.col("rate").isNotNull(), "RATE_MISSING"), (F.col("rate") >= 0, "RATE_NEGATIVE")]
    if with_note:
        checks.append((not_blank(F.col("note")), "NOTE_BLANK"))
    return first_error(*checks)


def name_error() -> Column:
    return first_error((not_blank(F.col("name")), "NAME_BLANK"))


def validate_requests(requests: DataFrame) -> DataFrame:
    """First error of each request of a mixed batch, by its ``kind``."""
    error = (
        F.when(F.col("kind") == "add_line", add_line_error())
        .when(F.col("kind") == "patch_line", patch_line_error())
        .when(F.col("kind") == "add_rate", rate_error(False))
        .when(F.col("kind") == "update_rate", rate_error(True))
        .when(F.col("kind") == "node", name_error())
        .otherwise("UNKNOWN_KIND")
    )
    return requests.select("kind", "req_id", error.alias("error"))
