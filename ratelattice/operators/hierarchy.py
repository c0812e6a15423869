"""Column tree, row tree, their numbering, and the documents made of them.

Siblings are ordered by id.  Every row carries the ids along its path, which
sort in display order; a row number is the count of rows before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelattice.functions import scalars as S
from ratelattice.operators.lookups import entry_cells
from ratelattice.skew import running_total
from ratelattice.sources.kept import keep
from ratelattice.sources.tables import RateTables

DEFAULT_TODAY = "2024-05-15 00:00:00"
FIRST_MATRIX_ROW = 5
SEGMENT_LINES = 1024
PATH = ["p0", "p1", "p2", "p3"]
AFTER_ALL = (1 << 63) - 1


def _today(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# ---- column tree ---------------------------------------------------------------------------


def _active_sub_categories(tables: RateTables) -> DataFrame:
    return tables.business_sub_category.filter("is_active = 1").select(
        F.col("id").alias("sub_category_id"), F.col("business_category_id").alias("category_id"), F.col("name").alias("sub_category")
    )


def _shown_sub_categories(tables: RateTables) -> DataFrame:
    """Active sub-categories of existing categories."""
    categories = tables.business_category.select(F.col("id").alias("category_id"))
    return _active_sub_categories(tables).join(categories, "category_id", "left_semi")


def _active_lines(tables: RateTables) -> DataFrame:
    return tables.product_line.filter("is_active = 1").select(
        F.col("id").alias("product_line_id"), F.col("business_sub_category_id").alias("sub_category_id"), "code", "base_rate"
    )


def column_tree(tables: RateTables, icons: bool = True) -> DataFrame:
    """Category -> active sub-category -> its columns, in display order.

    The first sub-category of a category opens with the title column; with
    ``icons`` every sub-category has an icon column; then its active product
    lines.  Categories without sub-categories are kept.
    """
    subs = _active_sub_categories(tables)
    first = subs.groupBy("category_id").agg(F.min("sub_category_id").alias("first_id"))
    subs = subs.join(first, "category_id").withColumn("is_first", F.col("sub_category_id") == F.col("first_id")).drop("first_id")
    lead = F.when(F.col("is_first"), 1).otherwise(0) + int(icons)

    lines = running_total(_active_lines(tables), ["sub_category_id"], ["product_line_id"], "nth")
    quoted = lines.join(subs, "sub_category_id").select(
        "category_id", "sub_category_id", "sub_category",
        (F.col("nth") + lead + 1).cast("int").alias("position"),
        F.col("code").alias("title"), F.col("code").alias("data_index"), "product_line_id",
    )

    def fixed(position: Column, title: str, index: str) -> Column:
        return F.struct(
            position.cast("int").alias("position"), F.lit(title).alias("title"), F.lit(index).alias("data_index")
        )

    heads = F.when(F.col("is_first"), F.array(fixed(F.lit(1), S.TITLE, S.TITLE_INDEX))).otherwise(F.array().cast("array<struct<position:int,title:string,data_index:string>>"))
    if icons:
        heads = F.concat(heads, F.array(fixed(lead, S.ICON, "")))
    head_rows = subs.select("category_id", "sub_category_id", "sub_category", F.inline(heads)).withColumn(
        "product_line_id", F.lit(None).cast("bigint")
    )
    body = head_rows.unionByName(quoted)
    if not icons:
        empty = subs.filter(~F.col("is_first")).join(_active_lines(tables), "sub_category_id", "left_anti")
        body = body.unionByName(empty.select("category_id", "sub_category_id", "sub_category"), allowMissingColumns=True)
    bare = tables.business_category.join(
        subs.select("category_id"), F.col("id") == F.col("category_id"), "left_anti"
    ).select(F.col("id").alias("category_id"))
    known = body.join(tables.business_category.select(F.col("id").alias("category_id")), "category_id", "left_semi")
    return known.unionByName(bare, allowMissingColumns=True)


def pl_counts(tables: RateTables) -> DataFrame:
    """Active product lines per sub-category and, with a null sub-category, per category."""
    subs = _active_sub_categories(tables).select("category_id", "sub_category_id")
    counts = _active_lines(tables).groupBy("sub_category_id").agg(F.count(F.lit(1)).alias("n"))
    per_sub = subs.join(counts, "sub_category_id", "left").select(
        "category_id", "sub_category_id", F.coalesce("n", F.lit(0)).alias("n")
    )
    categories = tables.business_category.select(F.col("id").alias("category_id"))
    per_sub = per_sub.join(categories, "category_id", "left_semi")
    totals = per_sub.groupBy("category_id").agg(F.sum("n").alias("n"))
    per_category = categories.join(totals, "category_id", "left").select(
        "category_id", F.lit(None).cast("int").alias("sub_category_id"), F.coalesce("n", F.lit(0)).alias("n")
    )
    return per_sub.unionByName(per_category)


def header_spans(tables: RateTables) -> DataFrame:
    """First and last matrix column of every category and sub-category header."""
    counts = pl_counts(tables)
    categories = running_total(
        counts.filter("sub_category_id IS NULL"), [], ["category_id"], "before", value=F.col("n")
    ).select("category_id", "n", "before")
    named = categories.join(
        tables.business_category.select(F.col("id").alias("category_id"), "name"), "category_id"
    ).select(F.lit("category").alias("level"), F.col("category_id").alias("id"), "name", "before", "n")
    within = running_total(
        counts.filter("sub_category_id IS NOT NULL"), ["category_id"], ["sub_category_id"], "inner", value=F.col("n")
    )
    subs = (
        within.join(categories.select("category_id", "before"), "category_id")
        .join(tables.business_sub_category.select(F.col("id").alias("sub_category_id"), "name"), "sub_category_id")
        .select(
            F.lit("sub_category").alias("level"), F.col("sub_category_id").alias("id"), "name",
            (F.col("before") + F.col("inner")).alias("before"), "n",
        )
    )
    return named.unionByName(subs).select(
        "level", "id", "name", (F.col("before") + 1).alias("first_col"), (F.col("before") + F.col("n")).alias("last_col")
    )


def column_axis(tables: RateTables) -> DataFrame:
    """Matrix column number of every active product line under an active sub-category."""
    lines = _active_lines(tables).join(_shown_sub_categories(tables), "sub_category_id")
    lines = running_total(lines, [], ["category_id", "sub_category_id", "product_line_id"], "before")
    return lines.select(
        (F.col("before") + 1).alias("position"), F.col("product_line_id").alias("id"), F.col("code").alias("label")
    )


def header_rows(tables: RateTables, today: str = DEFAULT_TODAY, wrap: bool = False) -> DataFrame:
    """Base-rate row and the rows of this and the next quarter, one cell per category and product-line code.

    Where several lines of a category share a code, the one with the highest id shows.
    """
    now = _today(today)
    none = F.lit(None).cast("decimal(18,4)")
    this_quarter = F.quarter(now)
    next_quarter = (this_quarter % 4 + 1) if wrap else (this_quarter + 1)
    rows = F.array(
        F.struct(S.base_rates_title(now).alias("row_title"), F.lit("").alias("quarter"), F.col("base_rate").alias("value")),
        F.struct(S.effective_title(now, 0, wrap).alias("row_title"), this_quarter.cast("string").alias("quarter"), none.alias("value")),
        F.struct(S.effective_title(now, 1, wrap).alias("row_title"), next_quarter.cast("string").alias("quarter"), none.alias("value")),
    )
    shown = _active_lines(tables).join(_shown_sub_categories(tables), "sub_category_id").withColumn("code", S.strip_quotes(F.col("code")))
    line = F.struct("product_line_id", "sub_category_id", "base_rate")
    last = shown.groupBy("category_id", "code").agg(F.max_by(line, "product_line_id").alias("line"))
    return last.select("category_id", "code", "line.*").select(
        "category_id",
        "code",
        F.col("sub_category_id").alias("business_sub_category_id"),
        "product_line_id",
        F.inline(rows),
    )


def column_tree_json(tables: RateTables, icons: bool = True) -> DataFrame:
    """The column tree as JSON documents, one per sub-category and segment.

    A sub-category with many product lines is written in segments of at most
    1024 consecutive positions, to be read in segment order.
    """
    column = F.struct("position", "title", F.col("data_index").alias("dataIndex"), F.col("product_line_id").alias("id"))
    shown = column_tree(tables, icons).filter("sub_category_id IS NOT NULL").withColumn(
        "segment", F.coalesce(F.floor((F.col("position") - 1) / SEGMENT_LINES), F.lit(0))
    )
    listed = F.array_sort(F.collect_list(F.when(F.col("position").isNotNull(), column)))
    return shown.groupBy("category_id", "sub_category_id", "sub_category", "segment").agg(listed.alias("children")).select(
        "category_id", "sub_category_id", "segment",
        F.to_json(
            F.struct(
                F.col("sub_category").alias("title"),
                F.col("sub_category_id").alias("businessSubCategoryId"),
                F.transform("children", lambda c: c.dropFields("position")).alias("children"),
            )
        ).alias("doc"),
    )


def header_rows_json(tables: RateTables, today: str = DEFAULT_TODAY, wrap: bool = False) -> DataFrame:
    """The header rows as JSON documents, one per category, row and sub-category, keyed by code.

    A sub-category with many lines is written in segments of at most 1024
    line ids.  Repeated codes are settled per category before that.
    """
    value = F.struct(
        "quarter",
        F.when(F.col("value").isNull(), F.array().cast("array<decimal(18,4)>")).otherwise(F.array("value")).alias("value"),
        F.col("business_sub_category_id").alias("businessSubCategoryId"),
    )
    group = ["category_id", "row_title", "business_sub_category_id", "segment"]
    segment = F.floor((F.col("product_line_id") - 1) / SEGMENT_LINES).alias("segment")
    cells = header_rows(tables, today, wrap).select("*", segment, value.alias("cell"))
    nested = cells.groupBy(*group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "cell")))).alias("cells"))
    return nested.select(*group, F.to_json(F.struct(F.col("row_title").alias("baserate"), "cells")).alias("doc"))


# ---- row tree ------------------------------------------------------------------------------


def _active_level(tables: RateTables, level: int) -> DataFrame:
    name = ["group_node", "node_l1", "node_l2", "node_l3"][level]
    parent = "business_category_id" if level == 0 else "parent_id"
    return getattr(tables, name).filter("is_active = 1").select(
        F.lit(level).alias("level"),
        F.col("id").cast("bigint").alias("id"),
        F.col(parent).cast("bigint").alias("parent_id"),
        "name",
    )


def _paths(tables: RateTables, depth: int = 4) -> list[DataFrame]:
    """The reachable active nodes, one frame per level, with the ids along their path.

    ``p0`` .. ``p3`` are the ids of the ancestors and the node itself, 0 below it, so
    that (category_id, p0, p1, p2, p3) is the depth-first order of the tree.
    """
    above = tables.business_category.select(F.col("id").cast("bigint").alias("__up"), F.col("id").alias("category_id"))
    frames = []
    for level in range(depth):
        nodes = _active_level(tables, level).join(above, F.col("parent_id") == F.col("__up")).drop("__up")
        nodes = nodes.withColumn(f"p{level}", F.col("id"))
        upper = [f"p{i}" for i in range(level + 1)]
        lower = [F.lit(0).cast("bigint").alias(f"p{i}") for i in range(level + 1, 4)]
        frames.append(nodes.select("category_id", "level", "id", "parent_id", "name", *upper, *lower))
        above = nodes.select(F.col("id").alias("__up"), "category_id", *upper)
    return frames


def row_tree(tables: RateTables, depth: int = 4) -> DataFrame:
    """Groups and nodes that are active along their whole path up to a category."""
    tree = reduce(DataFrame.unionByName, _paths(tables, depth))
    return tree.select("category_id", "level", "id", "parent_id", "name")


def row_tree_keys(tables: RateTables) -> DataFrame:
    """Display keys of the row tree, 1.. per category, placeholders included.

    A placeholder closes the child list of a group, level-1 or level-2 node.
    It carries the level of those children and the id of their parent.
    """
    frames = _paths(tables)
    rows = [f.withColumn("kind", F.lit("node")) for f in frames]
    for level, frame in enumerate(frames[:3]):
        rows.append(
            frame.withColumns(
                {
                    "kind": F.lit("placeholder"),
                    "level": F.lit(level + 1),
                    "name": F.lit(S.PLACEHOLDER),
                    f"p{level + 1}": F.lit(AFTER_ALL).cast("bigint"),
                }
            )
        )
    numbered = running_total(reduce(DataFrame.unionByName, rows), ["category_id"], PATH, "before")
    return numbered.select("category_id", (F.col("before") + 1).alias("key"), "kind", "level", "id", "name")


def row_axis(tables: RateTables) -> DataFrame:
    """Matrix row number of every reachable node, all categories in sequence."""
    tree = reduce(DataFrame.unionByName, _paths(tables))
    numbered = running_total(tree, [], ["category_id", *PATH], "before")
    return numbered.select(
        (F.col("before") + FIRST_MATRIX_ROW).alias("position"), "level", "id", S.strip_quotes(F.col("name")).alias("label")
    )


def matrix_axes(tables: RateTables) -> DataFrame:
    rows = row_axis(tables).select(F.lit("row").alias("axis"), "position", "level", "id", "label")
    columns = column_axis(tables).select(
        F.lit("col").alias("axis"), "position", F.lit(None).cast("int").alias("level"), "id", S.strip_quotes(F.col("label")).alias("label")
    )
    return rows.unionByName(columns)


def row_tree_cells(tables: RateTables, today: str = DEFAULT_TODAY) -> DataFrame:
    """Rate cells on the reachable level-2 and level-3 nodes; inactive product lines count."""
    nodes = row_tree(tables).filter("level >= 2").select("level", F.col("id").alias("node_id"))
    lines = tables.product_line.select(F.col("id").alias("product_line_id"), "code", "business_sub_category_id")
    cells = entry_cells(tables.rate_entry).join(nodes, ["level", "node_id"], "left_semi").join(lines, "product_line_id")
    return cells.select(
        "level", "node_id", S.strip_quotes(F.col("code")).alias("code"), "rate", "business_sub_category_id",
        "rate_entry_id", "product_line_id", F.quarter(_today(today)).alias("quarter"),
    )


def orphan_entries(entries: DataFrame, product_lines: DataFrame) -> DataFrame:
    """Entries naming a product line that does not exist."""
    lines = product_lines.select(F.col("id").alias("product_line_id"))
    return entries.join(lines, "product_line_id", "left_anti").select(F.col("id").alias("rate_entry_id"), "product_line_id")


def code_axis(tables: RateTables) -> DataFrame:
    """Every product-line code with its number in code order, from 0."""
    codes = tables.product_line.select(S.strip_quotes(F.col("code")).alias("code")).distinct()
    return running_total(codes, [], ["code"], "number")


def row_tree_pivot(tables: RateTables, width: int = 8) -> DataFrame:
    """Nodes with cells down, all product-line codes across, in bands of ``width`` columns r0, r1 ...

    Column i of a band holds the code numbered band * width + i by ``code_axis``; a band without
    cells of a node has no row.  Fixed-width aggregates, so a node quoted by very many lines is
    combined before the shuffle.  If two lines share a code the later entry shows.
    """
    cells = row_tree_cells(tables).join(code_axis(tables), "code")
    slot = F.col("number") % width
    columns = [F.max_by(F.when(slot == i, F.col("rate")), F.when(slot == i, F.col("rate_entry_id"))).alias(f"r{i}") for i in range(width)]
    return cells.groupBy("level", "node_id", F.floor(F.col("number") / width).alias("band")).agg(*columns)


def group_tree_json(tables: RateTables, today: str = DEFAULT_TODAY) -> DataFrame:
    """The row tree as JSON documents, one line per tree row, to be read in key order.

    The cells of a node are nested by product-line code.  A node quoted by
    many lines is written in segments of at most 1024 consecutive product-line
    ids, so no document grows with the table; segment 0 always exists.  Of the
    cells of a node that share a code the one with the highest entry id shows,
    settled before the segments are cut.
    """
    keys = row_tree_keys(tables)
    value = F.struct(
        F.col("quarter"),
        F.array("rate").alias("value"),
        F.col("business_sub_category_id").alias("businessSubCategoryId"),
        F.col("rate_entry_id").alias("rateEntryId"),
        F.col("product_line_id").alias("productLineId"),
    )
    latest = row_tree_cells(tables, today).groupBy("level", "node_id", "code").agg(F.max_by(value, "rate_entry_id").alias("cell"))
    latest = latest.withColumn("segment", F.floor((F.col("cell.productLineId") - 1) / SEGMENT_LINES))
    nested = latest.groupBy("level", "node_id", "segment").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "cell")))).alias("cells")
    )
    nodes = keys.filter("kind = 'node'")
    kinds = nodes.select("level", F.col("id").alias("node_id"), F.lit(0).cast("bigint").alias("segment"))
    segments = kinds.join(nested, ["level", "node_id", "segment"], "left").unionByName(nested.filter("segment > 0"))
    no_cells = F.map_from_entries(F.array().cast("array<struct<code:string,cell:struct<quarter:int,value:array<decimal(18,4)>,businessSubCategoryId:int,rateEntryId:bigint,productLineId:bigint>>>"))
    node_docs = nodes.join(segments.withColumnRenamed("node_id", "id"), ["level", "id"]).select(
        "category_id", "key", "segment",
        F.to_json(
            F.struct("key", "level", "id", F.lit(1).alias("isActive"), F.col("name").alias("baserate"), F.coalesce("cells", no_cells).alias("cells"))
        ).alias("doc"),
    )
    closing = keys.filter("kind = 'placeholder'").select(
        "category_id", "key", F.lit(0).cast("bigint").alias("segment"),
        F.to_json(F.struct("key", "level", F.col("id").alias("parentId"), F.col("name").alias("baserate"))).alias("doc"),
    )
    return node_docs.unionByName(closing)


def _json_text(column: str) -> Column:
    """The column as a JSON string, or null."""
    quoted = F.to_json(F.array(column))
    return F.when(F.col(column).isNull(), "null").otherwise(F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def category_tree_json(tables: RateTables, most: int = SEGMENT_LINES) -> DataFrame:
    """The row tree as nested JSON: (category_id, level, id, segment, children).

    Children are arrays inside their parent, closed by the placeholder; folded from the lowest
    level up.  Where the children of a node hold more than ``most`` tree rows together, they are
    cut into segments between children, written as rows of their own under the node's (level,
    id), and the node says how many ("segments").  The rows of level -1 are the categories.
    So no document grows with the table.  Walked in order, a category gives ``row_tree_keys``.
    """
    frames = _paths(tables)
    one = F.lit(1).cast("bigint").alias("size")
    rows, below = [], None
    for level in (3, 2, 1, 0):
        nodes = frames[level].select("category_id", "id", "parent_id", "name")
        head = F.concat(F.lit(f'{{"level":{level},"id":'), F.col("id"), F.lit(',"name":'), _json_text("name"))
        if below is None:
            done = nodes.select("category_id", "parent_id", F.col("id").alias("place"), one, F.concat(head, F.lit("}")).alias("doc"))
        else:
            parts, whole = _folded(below, most)
            rows.append(_segments(parts, whole, level))
            inside = F.when(F.col("n") == 1, F.concat(F.lit(',"children":['), "docs", F.lit("]}"))).otherwise(F.concat(F.lit(',"segments":'), F.col("n"), F.lit("}")))
            size = F.when(F.col("n") == 1, F.col("total") + 1).otherwise(1).alias("size")
            joined = nodes.join(whole.withColumnRenamed("parent_id", "id"), ["category_id", "id"])
            done = joined.select("category_id", "parent_id", F.col("id").alias("place"), size, F.concat(head, inside).alias("doc"))
        if level:
            closing = frames[level - 1].select(
                "category_id", F.col("id").alias("parent_id"), F.lit(AFTER_ALL).cast("bigint").alias("place"), one,
                F.concat(F.lit(f'{{"level":{level},"parentId":'), F.col("id"), F.lit(f',"name":"{S.PLACEHOLDER}"}}')).alias("doc"),
            )
            done = done.unionByName(closing)
        below = done
    parts, _ = _folded(below, most)
    rows.append(_segments(parts, None, -1))
    return reduce(DataFrame.unionByName, rows)


def _folded(below: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The children of each parent in order: their segments, and their number, size and first segment per parent."""
    numbered = running_total(below, ["category_id", "parent_id"], ["place"], "before", F.col("size"))
    parts = numbered.groupBy("category_id", "parent_id", F.floor(F.col("before") / most).alias("cut")).agg(
        F.sum("size").alias("size"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "doc"))), lambda c: c["doc"]), ",").alias("docs")
    )
    parts = keep(parts, "children")
    first = F.min(F.when(F.col("cut") == 0, F.col("docs"))).alias("docs")
    return parts, parts.groupBy("category_id", "parent_id").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), first)


def _segments(parts: DataFrame, whole: DataFrame | None, level: int) -> DataFrame:
    """The rows of the parents with several segments; of all parents where ``whole`` is left out."""
    keys = ["category_id", "parent_id"]
    cut = parts if whole is None else parts.join(whole.filter("n > 1").select(*keys), keys, "left_semi")
    numbered = running_total(cut.select(*keys, "cut", "docs"), keys, ["cut"], "segment")
    return numbered.select("category_id", F.lit(level).alias("level"), F.col("parent_id").alias("id"), "segment", F.concat(F.lit("["), "docs", F.lit("]")).alias("children"))


GRAM = 3  # characters of the longest entries of the search index


def _grams(text: Column) -> Column:
    """The distinct pieces of up to ``GRAM`` characters, the empty one included."""

    def pieces(n: int) -> Column:
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(text, i, F.lit(n)))

    return F.array_distinct(F.concat(F.array(F.lit("")), *map(pieces, range(1, GRAM + 1))))


def matching_labels(labels: DataFrame, queries: DataFrame) -> DataFrame:
    """The distinct (query, label) where the label contains the query, ignoring case.

    An inverted index of the labels' pieces: a query of up to ``GRAM`` characters is a piece
    itself; a longer one is looked up by the rarest of its pieces of that length, and what that finds is checked.
    """
    names = labels.select("label").filter("label IS NOT NULL").distinct()
    index = keep(names.select("label", F.explode(_grams(F.lower("label"))).alias("gram")), "grams")
    asked = queries.select("query").filter("query IS NOT NULL").distinct().withColumn("low", F.lower("query"))
    pieces = asked.select("query", "low", F.explode(_grams(F.col("low"))).alias("gram")).filter(F.length("gram") == F.least(F.length("low"), F.lit(GRAM)))
    counted = pieces.join(index.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "gram", "left")
    # a piece that no label has finds nothing
    rarest = counted.groupBy("query", "low").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    return rarest.join(index, "gram").filter(F.contains(F.lower("label"), F.col("low"))).select("query", "label")


def tree_search_table(tables: RateTables, queries: DataFrame) -> DataFrame:
    """``tree_search`` for the column ``query`` of a table."""
    groups, children = (frame.select("category_id", "level", "id", "parent_id", "name") for frame in _paths(tables, 2))
    # the placeholder is a child of every group, so the first group of a category stands for it
    closing = groups.groupBy("category_id").agg(F.min("id").alias("parent_id")).select(
        "category_id", F.lit(1).alias("level"), F.lit(None).cast("bigint").alias("id"), "parent_id", F.lit(S.PLACEHOLDER).alias("name")
    )
    nodes = keep(groups.unionByName(children).unionByName(closing), "searched")
    found = keep(matching_labels(nodes.withColumnRenamed("name", "label"), queries), "found").withColumnRenamed("label", "name")
    hits = nodes.join(found, "name")
    roots = hits.filter("level = 0")
    below = hits.filter("level = 1").join(roots.select("query", "category_id"), ["query", "category_id"], "left_anti")
    first = below.groupBy("query", "category_id").agg(F.min("parent_id").alias("parent_id"))
    shown = below.join(first, ["query", "category_id", "parent_id"], "left_semi")
    columns = ["query", "category_id", "level", "id", "name"]
    return roots.select(*columns).unionByName(shown.select(*columns))


def tree_search(tables: RateTables, texts: Sequence[str]) -> DataFrame:
    """Rows of each category's tree shown for each search text.

    The groups whose label contains the text, ignoring case; where no group
    of the category matches, the matching children of its first group that
    has any.  The closing placeholder is a child like any other.
    """
    queries = tables.business_category.sparkSession.createDataFrame([(text,) for text in texts], "query string")
    return tree_search_table(tables, queries)
