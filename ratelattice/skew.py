"""Windows that stay bounded when one group holds a large share of the rows.

A window ordered inside a group normally sends the whole group to one task.
Here the rows of hot groups, and the rows of table-wide numbering, are range-
partitioned by (group, order) first, so that a group spreads over as many
partitions as it needs.  The partition number is written with the rows; the
window then runs per (group, partition), and the slices of a group are stitched
through one summary row each.

Hot groups are found by counting buckets of groups, in a pass over the key columns that writes and shuffles next to nothing;
only the groups of buckets with too many rows are counted one by one, so no hot group is missed.  The input is not copied for this.
Which groups count as hot and where the slices end only decides the layout:
every choice yields the same rows.  Hot groups are looked up when the plan is
built, and the slices are written to the shared folder, so a recomputed task
sees the same ones.  Inputs below ``checkBytes`` (``tableBytes`` for numbering
without groups) skip all this: nothing in them can outgrow a task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelattice.sources.kept import keep

CHECK_BYTES = "ratelattice.skew.checkBytes"
TABLE_BYTES = "ratelattice.skew.tableBytes"
MAX_GROUP_ROWS = "ratelattice.skew.maxGroupRows"
DEFAULTS = {CHECK_BYTES: 32 << 20, TABLE_BYTES: 32 << 20, MAX_GROUP_ROWS: 2_000_000}

BUCKETS = 1 << 16  # of groups, counted before the groups themselves

_SLICE = "__slice"


def _setting(df: DataFrame, name: str) -> int:
    return int(df.sparkSession.conf.get(name, str(DEFAULTS[name])))


def scanned_bytes(df: DataFrame) -> int | None:
    """Bytes of the files and tables below ``df``; None where the planner is out of reach."""
    try:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    except AttributeError:
        return None
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def is_small(df: DataFrame, limit: str = CHECK_BYTES) -> bool:
    size = scanned_bytes(df)
    return size is not None and size < _setting(df, limit)


def hot_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The groups with more than ``maxGroupRows`` rows, as a kept table of their keys.

    No group outgrows its bucket, so the exact counts are taken in the buckets with more rows than that only;
    however many groups are hot, none is left out.
    """
    most = _setting(df, MAX_GROUP_ROWS)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("__bucket")
    named = df.select(*keys, bucket)
    full = keep(named.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > most).drop("__n"), "full")
    if full.isEmpty():
        return df.sparkSession.createDataFrame([], df.select(*keys).schema)
    counts = named.join(full, "__bucket", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return keep(counts.filter(F.col("__n") > most).drop("__n"), "hot")


def split_hot(df: DataFrame, keys: Sequence[str], counted: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ordinary groups and those of hot ones, the latter None where no group is hot."""
    hot = hot_groups(df if counted is None else counted, keys)
    if hot.isEmpty():
        return df, None
    named = hot.select(*[F.col(c).alias(f"__h_{c}") for c in keys])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__h_{c}")) for c in keys])
    return df.join(named, same, "left_anti"), df.join(named, same, "left_semi")


def slices(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows with a slice number that rises along ``by``; AQE keeps the slices at a fair size.

    Range partitioning samples its input before it moves it, so that is written first: the
    sample then reads only the columns of ``by``, and ``df`` is computed once.
    """
    ranged = keep(df, "rows").repartitionByRange(*by)
    return keep(ranged.withColumn(_SLICE, F.spark_partition_id()), "slices")


def _windowed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    whole: Callable[[DataFrame], DataFrame],
    sliced: Callable[[DataFrame], DataFrame],
    counted: DataFrame | None = None,
) -> DataFrame:
    """``whole`` on ordinary groups, ``sliced`` on the slices of hot ones; ``counted`` has the same groups and is cheaper to count."""
    if is_small(df, CHECK_BYTES if keys else TABLE_BYTES):
        return whole(df)
    if not keys:
        return sliced(slices(df, order))
    cool, hot = split_hot(df, keys, counted)
    return whole(cool) if hot is None else whole(cool).unionByName(sliced(slices(hot, [*keys, *order])))


def _join_slices(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on (keys, slice); keys may be null."""
    names = [*keys, _SLICE]
    right = summary.select(*[F.col(c).alias(f"__r_{c}") for c in names], *[c for c in summary.columns if c not in names])
    condition = F.lit(True)
    for c in names:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return df.join(right, condition, "left").drop(*[f"__r_{c}" for c in names])


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    value: Column | None = None,
    descending: bool = False,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Sum of ``value`` over the rows before each row of its group (0 for the first).

    With ``value`` left out it is the number of earlier rows, that is row_number - 1.
    ``order`` must be unique within a group.  ``counted`` may name a table with the same groups
    in which hot ones are looked up at less cost, like the input before a lookup join.
    """
    amount = F.lit(1).cast("bigint") if value is None else F.col("__value")
    sort = [F.col(c).desc() if descending else F.col(c).asc() for c in order]

    def total(part: DataFrame, groups: Sequence[str]) -> DataFrame:
        earlier = Window.partitionBy(*groups).orderBy(*sort)
        if value is None:
            return part.withColumn(out, F.row_number().over(earlier).cast("bigint") - 1)
        before = F.sum(amount).over(earlier.rowsBetween(Window.unboundedPreceding, -1))
        return part.withColumn(out, F.coalesce(before, F.lit(0)))

    def sliced(part: DataFrame) -> DataFrame:
        slice_order = F.col(_SLICE).desc() if descending else F.col(_SLICE).asc()
        before = Window.partitionBy(*keys).orderBy(slice_order).rowsBetween(Window.unboundedPreceding, -1)
        totals = part.groupBy(*keys, _SLICE).agg(F.sum(amount).alias("__total"))
        offsets = totals.withColumn("__offset", F.coalesce(F.sum("__total").over(before), F.lit(0))).drop("__total")
        joined = _join_slices(total(part, [*keys, _SLICE]), offsets, keys)
        return joined.withColumn(out, F.col(out) + F.col("__offset")).drop(_SLICE, "__offset")

    source = df if value is None else df.withColumn("__value", value.cast("bigint"))
    return _windowed(source, keys, order, lambda part: total(part, keys), sliced, counted).drop("__value")


def numbered(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """``running_total`` of the whole table without a value: the number of rows before each along ``order``.

    Rows are numbered within each value of the first column of ``order``, and a count per value says
    where its numbers start, so the rows themselves are moved once and not copied.
    """
    if is_small(df, TABLE_BYTES):
        return running_total(df, [], order, out)
    first = order[0]
    counts = keep(df.groupBy(F.col(first).alias("__first")).agg(F.count(F.lit(1)).alias("__n")), "counts")
    starts = running_total(counts, [], ["__first"], "__start", value=F.col("__n")).drop("__n")
    inner = running_total(df, [first], order[1:], out)
    joined = inner.join(starts, F.col(first).eqNullSafe(F.col("__first")))
    return joined.withColumn(out, F.col(out) + F.col("__start")).drop("__first", "__start")


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, str],
    following: bool = False,
) -> DataFrame:
    """Adds ``columns`` (new name -> source column) from the previous or following row of the group."""
    shift, edge_row = (F.lead, F.min_by) if following else (F.lag, F.max_by)

    def whole(part: DataFrame) -> DataFrame:
        ordered = Window.partitionBy(*keys).orderBy(*order)
        return part.withColumns({new: shift(old).over(ordered) for new, old in columns.items()})

    def sliced(part: DataFrame) -> DataFrame:
        ordered = Window.partitionBy(*keys, _SLICE).orderBy(*order)
        inner = part.withColumns({**{new: shift(old).over(ordered) for new, old in columns.items()}, "__inner": shift(F.lit(True)).over(ordered)})
        facing = F.struct(*[F.col(old).alias(new) for new, old in columns.items()])
        edges = part.groupBy(*keys, _SLICE).agg(edge_row(facing, F.struct(*order)).alias("__edge"))
        edges = edges.withColumn("__edge", shift("__edge").over(Window.partitionBy(*keys).orderBy(_SLICE)))
        joined = _join_slices(inner, edges, keys)
        picked = {new: F.when(F.col("__inner"), F.col(new)).otherwise(F.col(f"__edge.{new}")) for new in columns}
        return joined.withColumns(picked).drop(_SLICE, "__edge", "__inner")

    return _windowed(df, keys, order, whole, sliced)


def carried(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Adds ``columns`` (new name -> source column): the last non-null value up to and including each row of its group."""

    def whole(part: DataFrame) -> DataFrame:
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return part.withColumns({new: F.last(old, ignorenulls=True).over(upto) for new, old in columns.items()})

    def sliced(part: DataFrame) -> DataFrame:
        upto = Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        inner = part.withColumns({new: F.last(old, ignorenulls=True).over(upto) for new, old in columns.items()})
        at = F.struct(*order)
        ends = part.groupBy(*keys, _SLICE).agg(*[F.max_by(F.col(old), F.when(F.col(old).isNotNull(), at)).alias(f"__e_{new}") for new, old in columns.items()])
        before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.withColumns({f"__e_{new}": F.last(f"__e_{new}", ignorenulls=True).over(before) for new in columns})
        joined = _join_slices(inner, ends, keys)
        return joined.withColumns({new: F.coalesce(new, f"__e_{new}") for new in columns}).drop(_SLICE, *[f"__e_{new}" for new in columns])

    return _windowed(df, keys, order, whole, sliced)


_KINDS = {"sum": (F.sum, lambda one, other: one + other), "min": (F.min, F.least), "max": (F.max, F.greatest)}


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, tuple[str, str]], ordinary: bool = False) -> DataFrame:
    """Adds ``columns`` (new name -> (kind, source column)): aggregates over the rows before each row of its group.

    Kinds are sum (0 where nothing comes before), min, max and last (the last non-null value).
    ``order`` must be unique within a group.  ``ordinary`` says that no group is hot, as of ``split_hot``.
    """

    def made(name: str, kind: str, over: Window, source: str) -> Column:
        if kind == "last":
            return F.last(source, ignorenulls=True).over(over)
        value = _KINDS[kind][0](source).over(over)
        return F.coalesce(value, F.lit(0)) if kind == "sum" else value

    def whole(part: DataFrame) -> DataFrame:
        before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return part.withColumns({new: made(new, kind, before, old) for new, (kind, old) in columns.items()})

    def sliced(part: DataFrame) -> DataFrame:
        before = Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        inner = part.withColumns({new: made(new, kind, before, old) for new, (kind, old) in columns.items()})
        at = F.struct(*order)
        ends = part.groupBy(*keys, _SLICE).agg(
            *[
                (F.max_by(F.col(old), F.when(F.col(old).isNotNull(), at)) if kind == "last" else _KINDS[kind][0](old)).alias(f"__e_{new}")
                for new, (kind, old) in columns.items()
            ]
        )
        earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.withColumns({f"__e_{new}": made(new, kind, earlier, f"__e_{new}") for new, (kind, _) in columns.items()})
        joined = _join_slices(inner, ends, keys)
        both = {}
        for new, (kind, _) in columns.items():
            mine, offset = F.col(new), F.col(f"__e_{new}")
            both[new] = F.coalesce(mine, offset) if kind == "last" else _KINDS[kind][1](mine, offset)
        return joined.withColumns(both).drop(_SLICE, *[f"__e_{new}" for new in columns])

    return whole(df) if ordinary else _windowed(df, keys, order, whole, sliced)
