"""Rates over time: as-of values, validity intervals, change history and lineage.

Changes of one entry are ordered by (created_on, id): of two changes with the
same timestamp the one with the higher log id is the later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelattice.functions.scalars import HISTORY_MINUTES
from ratelattice.schemas import RATE
from ratelattice.skew import carried, neighbour, running_total, scanned_bytes
from ratelattice.sources.kept import by_portion, portion, portions
from ratelattice.sources.tables import RateTables

DEFAULT_AS_OF = "1998-06-30 23:59:00"
ORDER = ["created_on", "id"]
SEGMENT_CHANGES = 1024
NO_CHANGES = "array<struct<date:string,baseRate:decimal(18,4),notes:string,attachment:string,modifiedBy:string>>"


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _latest(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last change per group.

    The changes of a group are reduced to one per map task before the only
    shuffle, however many there are.  (Settling ties in a separate step would
    stay with hash aggregation but shuffle nearly every change; measured slower.)
    """
    last = F.max_by(F.struct("rate", "created_on"), F.struct(*ORDER))
    return changes.groupBy(*keys).agg(last.alias("last")).select(*keys, "last.rate", "last.created_on")


def rate_asof(log: DataFrame, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """The rate of every entry at ``as_of``, a change at that very moment included.

    Entries without a change by then are absent.
    """
    return _latest(log.filter(F.col("created_on") <= moment(as_of)), ["rate_entry_id"])


def rate_asof_multi(log: DataFrame, moments: Sequence[str]) -> DataFrame:
    """``rate_asof`` for several moments in one pass over the log.

    Each change is booked under the first moment that sees it, the bookings are
    reduced to one row per (entry, moment), and only that small result is
    spread over the moments up to the next booking.
    """
    ordered = sorted(set(moments))
    slot = F.lit(0)
    for m in ordered:
        slot = slot + (F.col("created_on") > moment(m)).cast("int")
    seen = log.filter(F.col("created_on") <= moment(ordered[-1])).withColumn("slot", slot)
    booked = _latest(seen, ["rate_entry_id", "slot"])
    upto = F.lead("slot").over(Window.partitionBy("rate_entry_id").orderBy("slot"))
    spread = booked.withColumn("upto", F.coalesce(upto, F.lit(len(ordered))) - 1)
    times = F.array(*[moment(m) for m in ordered])
    return spread.select(
        F.explode(F.slice(times, F.col("slot") + 1, F.col("upto") - F.col("slot") + 1)).alias("as_of"),
        "rate_entry_id",
        "rate",
    )


def rate_asof_probes(log: DataFrame, probes: DataFrame) -> DataFrame:
    """The rate at each of many (probe_id, rate_entry_id, as_of) probes, null where the entry has no change by then.

    Probes and changes are sorted together per entry, so no range join is needed and an entry
    with very many of both costs no pairs.
    """
    changes = log.select(
        "rate_entry_id", F.col("created_on").alias("at"), F.lit(0).alias("kind"), F.col("id").alias("number"), "rate"
    )
    asked = probes.select(
        "rate_entry_id", F.col("as_of").alias("at"), F.lit(1).alias("kind"), F.col("probe_id").alias("number"), F.lit(None).cast(RATE).alias("rate")
    )
    seen = carried(changes.unionByName(asked), ["rate_entry_id"], ["at", "kind", "number"], {"known": "rate"})
    return seen.filter("kind = 1").select(F.col("number").alias("probe_id"), "rate_entry_id", F.col("at").alias("as_of"), F.col("known").alias("rate"))


def rate_changes(log: DataFrame) -> DataFrame:
    """Old and new rate of every change; the first change of an entry has old = new."""
    df = neighbour(log, ["rate_entry_id"], ORDER, {"previous": "rate"})
    return df.select("rate_entry_id", "created_on", F.coalesce("previous", "rate").alias("old_rate"), "rate")


def rate_intervals(log: DataFrame) -> DataFrame:
    """Validity interval of every change, open-ended for the last.

    Of changes tied on the timestamp all but the last get an empty interval.
    """
    df = neighbour(log, ["rate_entry_id"], ORDER, {"valid_to": "created_on"}, following=True)
    return df.select("rate_entry_id", "rate", F.col("created_on").alias("valid_from"), "valid_to")


def entry_history(log: DataFrame, attachments: DataFrame) -> DataFrame:
    """Change history per entry, newest first, showing the rate before each change."""
    paths = attachments.select(F.col("id").alias("__aid"), F.col("path").alias("attachment"))
    df = log.join(paths, log["attachment_id"] == paths["__aid"]).drop("__aid")
    df = running_total(df, ["rate_entry_id"], ORDER, "seq", descending=True, counted=log)
    return df.select(
        "rate_entry_id",
        (F.col("seq") + 1).alias("seq"),
        F.date_format("created_on", HISTORY_MINUTES).alias("date"),
        F.col("old_rate").alias("base_rate"),
        F.col("note").alias("notes"),
        "attachment",
        F.col("created_by").alias("modified_by"),
    )


def entry_detail_json(tables: RateTables) -> DataFrame:
    """Lineage and history of every entry as JSON, in segments of at most 1024 changes.

    Segments run from the newest changes to the oldest; an entry without
    history has one segment with an empty list.
    """
    change = F.struct("seq", "date", F.col("base_rate").alias("baseRate"), "notes", "attachment", F.col("modified_by").alias("modifiedBy"))
    log, rate_entry, attachments = tables.rate_change_log, tables.rate_entry, tables.attachment
    of = portions(tables.spark, scanned_bytes(log))

    def documents(number: int) -> DataFrame:
        changes = portion(log, F.col("rate_entry_id"), number, of)
        history = entry_history(changes, attachments).withColumn("segment", F.floor((F.col("seq") - 1) / SEGMENT_CHANGES))
        nested = history.groupBy("rate_entry_id", "segment").agg(F.array_sort(F.collect_list(change)).alias("changes"))
        entries = entry_lineage(tables, portion(rate_entry, F.col("id"), number, of)).join(nested, "rate_entry_id", "left")
        return entries.select(
            "rate_entry_id",
            F.coalesce("segment", F.lit(0)).alias("segment"),
            F.to_json(
                F.struct(
                    "category", F.col("group_name").alias("group"), F.col("product_line").alias("productLine"), "seller", "rate",
                    F.coalesce(F.transform("changes", lambda c: c.dropFields("seq")), F.expr("array()").cast(NO_CHANGES)).alias("changes"),
                )
            ).alias("doc"),
        )

    return by_portion(tables.spark, of, documents, "documents")


def missing_attachments(log: DataFrame, attachments: DataFrame) -> DataFrame:
    """Changes whose attachment row does not exist."""
    return log.join(
        attachments.select(F.col("id").alias("attachment_id")), "attachment_id", "left_anti"
    ).select("rate_entry_id", F.col("id").alias("log_id"), "attachment_id")


def lineage_errors(tables: RateTables) -> DataFrame:
    """(rate_entry_id, missing, missing_id): what an entry's lineage names and does not find, one row per break.

    ``missing`` is one of level_1, level_2, level_3, product_line, sub_category, category.
    """

    def breaks(rows: DataFrame, column: str, table: DataFrame, name: str) -> DataFrame:
        known = table.select(F.col("id").cast("bigint").alias("missing_id"))
        named = rows.select("rate_entry_id", F.col(column).cast("bigint").alias("missing_id")).filter("missing_id IS NOT NULL")
        return named.join(known, "missing_id", "left_anti").select("rate_entry_id", F.lit(name).alias("missing"), "missing_id")

    def below(rows: DataFrame, column: str, table: DataFrame, up: str) -> DataFrame:
        above = table.select(F.col("id").cast("bigint").alias("__at"), F.col(up).alias("__up"))
        return rows.join(above, F.col(column) == F.col("__at")).select("rate_entry_id", F.col("__up").alias(column))

    entries = tables.rate_entry.select(F.col("id").alias("rate_entry_id"), "product_line_id", "l2_id", "l3_id")
    alone = entries.filter(F.col("l2_id").isNull() != F.col("l3_id").isNull())
    level2 = alone.select("rate_entry_id", "l2_id").unionByName(below(alone, "l3_id", tables.node_l3, "parent_id").withColumnRenamed("l3_id", "l2_id"))
    level1 = below(level2, "l2_id", tables.node_l2, "parent_id")
    subs = below(entries, "product_line_id", tables.product_line, "business_sub_category_id")
    categories = below(subs, "product_line_id", tables.business_sub_category, "business_category_id")
    return (
        breaks(alone, "l3_id", tables.node_l3, "level_3")
        .unionByName(breaks(level2, "l2_id", tables.node_l2, "level_2"))
        .unionByName(breaks(level1, "l2_id", tables.node_l1, "level_1"))
        .unionByName(breaks(entries, "product_line_id", tables.product_line, "product_line"))
        .unionByName(breaks(subs, "product_line_id", tables.business_sub_category, "sub_category"))
        .unionByName(breaks(categories, "product_line_id", tables.business_category, "category"))
    )


def entry_lineage(tables: RateTables, entries: DataFrame | None = None) -> DataFrame:
    """Where each entry belongs: seller node, level-1 group, product line, category.

    The seller is the level-2 or the level-3 node, whichever alone is set; an
    entry with both or neither has no seller and no group.  Entries whose lineage
    is broken are left out here and listed by ``lineage_errors``.  ``entries`` may name some of the entries.
    """
    l1 = tables.node_l1.select(F.col("id").alias("l1_id"), F.col("name").alias("dgroup"))
    l2 = (
        tables.node_l2.select(F.col("id").alias("l2_id"), "parent_id", F.col("name").alias("l2_name"))
        .join(l1, F.col("parent_id") == F.col("l1_id"))
        .select("l2_id", "l2_name", "dgroup")
    )
    sellers = l2.select(
        F.lit(2).alias("level"), F.col("l2_id").cast("bigint").alias("node_id"), F.col("l2_name").alias("seller"), "dgroup"
    ).unionByName(
        tables.node_l3.join(l2, F.col("parent_id") == F.col("l2_id")).select(
            F.lit(3).alias("level"), F.col("id").alias("node_id"), F.col("name").alias("seller"), "dgroup"
        )
    )
    categories = tables.business_category.select(F.col("id").alias("cid"), F.col("name").alias("category"))
    subs = tables.business_sub_category.select(F.col("id").alias("sid"), F.col("business_category_id").alias("cid"))
    lines = (
        tables.product_line.select(F.col("id").alias("plid"), F.col("code").alias("product_line"), F.col("business_sub_category_id").alias("sid"))
        .join(subs, "sid")
        .join(categories, "cid")
        .select("plid", "product_line", "category")
    )
    single = F.col("l2_id").isNull() != F.col("l3_id").isNull()
    entries = tables.rate_entry if entries is None else entries
    entries = entries.select(F.col("id").alias("rate_entry_id"), "product_line_id", "rate", "l2_id", "l3_id")
    placed = entries.filter(single).select(
        "rate_entry_id", "product_line_id", "rate",
        F.when(F.col("l2_id").isNotNull(), 2).otherwise(3).alias("level"),
        F.coalesce(F.col("l2_id").cast("bigint"), F.col("l3_id")).alias("node_id"),
    ).join(sellers, ["level", "node_id"])
    loose = entries.filter(~single).withColumns({"seller": F.lit(None).cast("string"), "dgroup": F.lit(None).cast("string")})
    columns = ["rate_entry_id", "product_line_id", "rate", "seller", "dgroup"]
    return (
        placed.select(*columns)
        .unionByName(loose.select(*columns))
        .join(lines, F.col("product_line_id") == F.col("plid"))
        .select("rate_entry_id", "category", F.col("dgroup").alias("group_name"), "product_line", "seller", "rate")
    )
