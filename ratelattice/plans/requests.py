"""Request batches derived from the whole star-schema inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelattice.schemas import RATE
from ratelattice.sources.tables import DerivedTables, RateTables

BATCH_DAY = "TIMESTAMP_NTZ '2024-05-15 00:00:00'"


def _derived(tables: RateTables) -> DerivedTables:
    """The derivation over the same inputs, for requests that follow the parts and line items."""
    if isinstance(tables, DerivedTables):
        return tables
    if not hasattr(tables, "_request_source"):
        tables._request_source = DerivedTables(tables.spark, tables.inputs_directory)
    return tables._request_source


def add_line_requests(tables: RateTables) -> DataFrame:
    """Every supplier asks for its own code, every order for the code of its customer."""
    own = tables.input("supplier").select(
        (F.col("s_suppkey") * 2).alias("req_id"),
        F.expr("TIMESTAMP_NTZ '1992-01-01 00:00:00'").alias("req_ts"),
        F.col("s_name").alias("code"),
        (F.col("s_nationkey") + 1).alias("business_sub_category_id"),
        F.col("s_acctbal").cast(RATE).alias("base_rate"),
    )
    customers = tables.input("customer").select("c_custkey", "c_name", "c_nationkey")
    orders = tables.input("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return own.unionByName(
        orders.select(
            (F.col("o_orderkey") * 2 + 1).alias("req_id"),
            F.col("o_orderdate").alias("req_ts"),
            F.col("c_name").alias("code"),
            (F.col("c_nationkey") + 1).alias("business_sub_category_id"),
            F.col("o_totalprice").cast(RATE).alias("base_rate"),
        )
    )


def patch_line_requests(tables: RateTables) -> DataFrame:
    """Every order patches the line numbered like its customer."""
    return tables.input("orders").select(
        F.col("o_orderkey").alias("req_id"),
        F.col("o_orderdate").alias("req_ts"),
        (F.col("o_custkey") + 1).alias("product_line_id"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("PL-"), F.col("o_orderkey"))).alias("code"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice").cast(RATE) - 100000).cast(RATE).alias("base_rate"),
    )


def delete_line_requests(tables: RateTables) -> DataFrame:
    """Customers in debt close the line numbered like them."""
    debtors = tables.input("customer").filter("c_acctbal < 0")
    return debtors.select(F.col("c_custkey").alias("req_id"), F.expr(BATCH_DAY).alias("req_ts"), (F.col("c_custkey") + 1).alias("product_line_id"))


def node_requests(tables: RateTables) -> DataFrame:
    """Every part asks for the nodes on its path and for four more named after it."""
    parts = _derived(tables).part_nodes
    category = (1 + (F.col("g_id") - 1) % 5).cast("bigint")

    def wanted(k: int, level: int, parent, name):
        return F.struct(
            (F.col("p_partkey") * 8 + k).alias("req_id"),
            F.lit(level).alias("level"),
            parent.cast("bigint").alias("parent_id"),
            name.alias("name"),
        )

    rows = F.array(
        wanted(0, 3, F.col("l2_id"), F.concat("p_name", F.lit("#"), "p_partkey")),
        wanted(1, 3, F.col("l2_id"), F.col("p_name")),
        wanted(2, 2, F.col("l1_id"), F.col("p_brand")),
        wanted(3, 2, F.col("l1_id"), F.col("p_name")),
        wanted(4, 1, F.col("g_id"), F.concat(F.lit("SIZE-BAND-"), "size_band")),
        wanted(5, 1, F.col("g_id"), F.col("p_brand")),
        wanted(6, 0, category, F.col("p_type")),
        wanted(7, 0, category, F.col("p_brand")),
    )
    return parts.select(F.expr(f"{BATCH_DAY} + make_dt_interval(p_size)").alias("req_ts"), F.inline(rows))


def delete_node_requests(tables: RateTables, nodes: DataFrame) -> DataFrame:
    """One group, one size band, one brand, and a level-3 node per urgent order."""
    named = nodes.filter(
        "(level = 0 AND name = 'STANDARD') OR (level = 1 AND name = 'SIZE-BAND-2') OR (level = 2 AND name = 'Brand#7')"
    ).select("level", "id")
    urgent = tables.input("orders").filter("o_orderpriority = '1-URGENT'")
    return named.unionByName(urgent.select(F.lit(3).alias("level"), (F.col("o_orderkey") + 1).alias("id")))


def rename_requests(tables: RateTables) -> DataFrame:
    """Every part renames the nodes on its path, every order one level-2 node."""
    parts = _derived(tables).part_nodes

    def renamed(k: int, level: int, node: str, name):
        return F.struct(
            (F.col("p_partkey") * 8 + k).alias("req_id"), F.lit(level).alias("level"), F.col(node).cast("bigint").alias("id"), name.alias("name")
        )

    rows = F.array(
        renamed(0, 3, "l3_id", F.upper("p_name")),
        renamed(1, 2, "l2_id", F.concat("p_brand", F.lit("/"), "p_partkey")),
        renamed(2, 1, "l1_id", F.concat("p_name", F.lit(" "), "size_band")),
        renamed(3, 0, "g_id", F.concat("p_type", F.lit(" "), "p_brand")),
    )
    orders = tables.input("orders").select(
        F.expr(f"{BATCH_DAY}").alias("req_ts"),
        (F.col("o_orderkey") * 8 + 7).alias("req_id"),
        F.lit(2).alias("level"),
        (F.col("o_orderkey") + 1).alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("ORDER "), "o_orderkey")).otherwise("  ").alias("name"),
    )
    return parts.select(F.expr(f"{BATCH_DAY} + make_dt_interval(p_size)").alias("req_ts"), F.inline(rows)).unionByName(orders)


def update_rate_requests(tables: RateTables) -> DataFrame:
    """Every line item asks for a new rate of its level-3 cell and of its level-2 cell."""
    tax, discount = F.col("l_tax").cast(RATE), F.col("l_discount").cast(RATE)

    def change(offset: int, entry: str, rate):
        return F.struct(
            (F.col("line_id") + offset).alias("req_id"), F.col(entry).alias("rate_entry_id"), rate.cast(RATE).alias("rate")
        )

    rows = F.array(change(1, "l3_entry_id", tax), change(0, "l2_entry_id", discount + tax))
    blank = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    return _derived(tables).line_nodes.select(
        F.col("l_shipdate").alias("req_ts"),
        F.when(blank, "  ").otherwise(F.concat("l_returnflag", "l_linestatus")).alias("note"),
        F.col("l_linenumber").alias("attachment_id"),
        F.inline(rows),
    )


def add_rate_requests(tables: RateTables) -> DataFrame:
    """Every line item asks for cells of its nodes under the next supplier's line."""
    names = tables.input("supplier").select(F.col("s_suppkey").alias("__key"), F.col("s_name").alias("__name"))
    lines = _derived(tables).line_nodes.join(names, F.col("l_suppkey") + 1 == F.col("__key"), "left")
    tax, discount = F.col("l_tax").cast(RATE), F.col("l_discount").cast(RATE)

    def wanted(offset: int, l2, l3, rate):
        return F.struct(
            (F.col("line_id") + offset).alias("req_id"),
            l2.cast("int").alias("l2_id"),
            l3.cast("bigint").alias("l3_id"),
            rate.cast(RATE).alias("rate"),
        )

    rows = F.array(wanted(1, F.lit(None), F.col("l3_id"), tax), wanted(0, F.col("l2_id"), F.lit(None), discount + tax))
    return lines.select(
        F.col("l_shipdate").alias("req_ts"),
        F.coalesce("__name", F.concat(F.lit("UNKNOWN-"), "l_suppkey")).alias("product_line_name"),
        F.inline(rows),
    )


def requested_cells(tables: RateTables) -> DataFrame:
    """The cells named by ``add_rate_requests``, as (level, node_id, product_line_id)."""
    lines = tables.product_line.select(F.col("code").alias("product_line_name"), F.col("id").alias("product_line_id"))
    requests = add_rate_requests(tables).join(lines, "product_line_name")
    return requests.select(
        F.when(F.col("l3_id").isNotNull(), 3).otherwise(2).alias("level"),
        F.coalesce("l3_id", F.col("l2_id").cast("bigint")).alias("node_id"),
        "product_line_id",
    )


def mixed_requests(tables: RateTables) -> DataFrame:
    """Requests of several kinds in one frame, for the request checks."""
    lines = add_line_requests(tables).withColumn("kind", F.lit("add_line")).drop("req_ts")
    patches = patch_line_requests(tables).withColumn("kind", F.lit("patch_line")).drop("req_ts", "product_line_id")
    rates = update_rate_requests(tables).withColumn("kind", F.lit("update_rate")).select("kind", "req_id", "rate", "note")
    nodes = tables.input("documents").select(F.lit("node").alias("kind"), F.col("doc_id").alias("req_id"), F.col("text").alias("name"))
    result = lines
    for part in (patches, rates, nodes):
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def sheet_lines(tables: RateTables) -> DataFrame:
    """One delimited sheet row per order: nine positional cells, the last one replacing the fifth."""
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    override = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string")).otherwise("")
    cells = [
        F.col("o_orderkey"), stamp, F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderkey") + 1,
        F.lit(""), F.col("o_custkey") + 1, F.col("o_totalprice").cast(RATE), override,
    ]
    return tables.input("orders").select(F.concat_ws(",", *[c.cast("string") for c in cells]).alias("line"))


def asked_quarters(tables: RateTables) -> DataFrame:
    """The quarter of every order's date, or one that no colour has."""
    quarter = F.when(F.col("o_orderstatus") == "P", "Q9").otherwise(F.concat(F.lit("Q"), F.quarter("o_orderdate")))
    return tables.input("orders").select("o_orderkey", quarter.alias("fy_quarter"))


class GapTables(RateTables):
    """The tables without every fifth node, line and category."""

    GAPS = ("node_l1", "node_l2", "node_l3", "product_line", "business_sub_category", "business_category")

    def __init__(self, base: RateTables):
        super().__init__(base.spark, base.directory)
        self._base = base

    def __getattr__(self, name: str) -> DataFrame:
        df = getattr(self._base, name)
        return df.filter(F.col("id") % 5 != 0) if name in self.GAPS else df


def broken_sheet_lines(tables: RateTables) -> DataFrame:
    """Sheet rows of which five in six have something wrong: too short, a bad id, date, rate or line."""
    kind = F.col("o_orderkey") % 6
    stamp = F.when(kind == 2, "2024-13-45").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    cells = [
        F.when(kind == 1, F.concat(F.lit("x"), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string")), stamp, F.col("o_orderpriority"), F.col("o_orderstatus"),
        F.col("o_orderkey") + 1, F.lit(""), F.when(kind == 5, "1.5").otherwise((F.col("o_custkey") + 1).cast("string")),
        F.when(kind == 3, "").otherwise(F.col("o_totalprice").cast(RATE).cast("string")), F.lit(""),
    ]
    whole = F.concat_ws(",", *[c.cast("string") for c in cells])
    short = F.concat_ws(",", *[c.cast("string") for c in cells[:3]])
    return tables.input("orders").select(F.when(kind == 0, short).otherwise(whole).alias("line"))


def search_texts(tables: RateTables) -> DataFrame:
    """The first four characters of every word of the group labels."""
    words = F.explode(F.split("name", " ")).alias("word")
    return tables.group_node.unionByName(tables.node_l1, allowMissingColumns=True).select(words).select(F.substring("word", 1, 4).alias("query")).filter("query <> ''").distinct()


def rate_request_texts(tables: RateTables) -> DataFrame:
    """Every event as a JSON request; error events are cut off."""
    rate = F.col("value").cast(RATE).cast("string")
    full = F.concat(F.lit('{"rate": '), rate, F.lit(', "note": "'), F.col("event_type"), F.lit('"}'))
    broken = F.concat(F.lit('{"rate": '), rate, F.lit(', "no'))
    return tables.input("events").select(F.when(F.col("event_type") == "error", broken).otherwise(full).alias("raw"))


def cookies(tables: RateTables) -> DataFrame:
    """A session cookie per customer; machinery customers lack the token part."""
    token = F.concat(F.lit('{"id_token":{"user_name":"'), F.col("c_name"), F.lit('"}}'))
    coded = F.rtrim(F.translate(F.base64(F.encode(token, "UTF-8")), "+/", "-_"), F.lit("="))
    head = F.concat(F.lit("sid|"), F.col("c_custkey"))
    return tables.input("customer").select(
        F.when(F.col("c_mktsegment") == "MACHINERY", head).otherwise(F.concat(head, F.lit("|"), coded)).alias("cookie")
    )


def upload_names(tables: RateTables) -> DataFrame:
    """Three upload names per page: its address, its last path part, and one with a double dot."""
    last = F.element_at(F.split("url", "/"), -1)
    return tables.input("pages").select(
        F.explode(F.array(F.col("url"), last, F.concat(F.lit("page.."), F.col("page_id")))).alias("original")
    )
