"""Column layout of the stored tables, as DDL strings."""

RATE = "decimal(18,4)"

TABLES = {
    "business_category": "id int, description string, is_active tinyint, last_modified_ts timestamp_ntz, modified_by string, name string",
    "business_sub_category": "id int, business_category_id int, description string, is_active tinyint, last_modified_ts timestamp_ntz, modified_by string, name string",
    "product_line": f"id bigint, business_sub_category_id int, code string, is_active tinyint, last_modified_ts timestamp_ntz, modified_by string, base_rate {RATE}, color_code_id int",
    "color_code": "id int, code string, fy_quarter string, fy_year string, name string",
    "group_node": "id int, business_category_id int, is_active tinyint, last_modified_ts timestamp_ntz, modified_by string, name string",
    "node_l1": "id int, parent_id int, is_active tinyint, last_modified_ts timestamp_ntz, modified_by string, name string",
    "node_l2": "id int, parent_id int, is_active tinyint, last_modified_ts timestamp_ntz, modified_by string, name string",
    "node_l3": "id bigint, parent_id int, is_active tinyint, last_modified_ts timestamp_ntz, modified_by string, name string",
    "rate_entry": f"id bigint, attachment_id int, created_by string, created_on timestamp_ntz, rate {RATE}, l2_id int, l3_id bigint, note string, product_line_id bigint",
    "rate_change_log": f"id bigint, attachment_id int, created_by string, created_on timestamp_ntz, rate {RATE}, old_rate {RATE}, rate_entry_id bigint, note string",
    "attachment": "id int, path string",
    "event_change_log": f"id bigint, rate_entry_id bigint, created_on timestamp_ntz, rate {RATE}, created_by string, note string",
    "audit_log": "id bigint, ip string, username string, endpoint string, type string, status string, message string, create_time timestamp_ntz",
}


def fields(table: str) -> list[tuple[str, str]]:
    """(column, type) of a stored table."""
    return columns_of(TABLES[table])


def columns_of(ddl: str) -> list[tuple[str, str]]:
    """(column, type) of a DDL text."""
    out, depth, start, ddl = [], 0, 0, ddl + ","
    for i, ch in enumerate(ddl):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            column, kind = ddl[start:i].strip().split(" ", 1)
            out.append((column, kind))
            start = i + 1
    return out


# Layout of the star-schema inputs the tables above can be derived from.
INPUTS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
