"""The registered queries: name -> function of the tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelattice.functions import scalars as S
from ratelattice.operators import admission, checks, hierarchy, history, lookups, matrix, mutations, snapshots
from ratelattice.plans import requests as R
from ratelattice.skew import scanned_bytes
from ratelattice.sources import sheets
from ratelattice.sources.kept import by_portion, keep_tidy, portion, portions, shared_folder
from ratelattice.sources.tables import RateTables

MOMENTS = [f"{year}-06-30 23:59:00" for year in range(1993, 2001)]
SEARCHES = ["mall", "band-2", "SUB GROUP"]

Plan = Callable[[RateTables], DataFrame]
PLANS: dict[str, Plan] = {}


def plan(function: Plan) -> Plan:
    PLANS[function.__name__] = function
    return function


@plan
def rate_matrix_asof(t):
    return matrix.rate_matrix_asof(t)


@plan
def rate_matrix_sheet(t):
    return matrix.matrix_sheet(matrix.rate_matrix_asof(t))


@plan
def rate_sheet_labelled(t):
    return matrix.labelled_sheet(t)


@plan
def rate_asof(t):
    return history.rate_asof(t.rate_change_log)


@plan
def rate_asof_snapshots(t):
    folder = f"{shared_folder(t.spark)}/rates-{uuid.uuid4().hex}"
    snapshots.create_store(t.rate_change_log, folder, [date(1996, 1, 1), date(1998, 1, 1)])
    return snapshots.rate_asof_stored(t.spark, folder, history.DEFAULT_AS_OF)


@plan
def rate_asof_multi(t):
    return history.rate_asof_multi(t.rate_change_log, MOMENTS)


@plan
def rate_asof_events(t):
    return history.rate_asof(t.event_change_log, "2024-01-15 12:00:00")


@plan
def rate_asof_probes(t):
    """The rate each update request finds at its own time."""
    probes = R.update_rate_requests(t).select(F.col("req_id").alias("probe_id"), "rate_entry_id", F.col("req_ts").alias("as_of"))
    return history.rate_asof_probes(t.rate_change_log, probes)


@plan
def lineage_errors(t):
    return history.lineage_errors(t)


@plan
def lineage_errors_with_gaps(t):
    return history.lineage_errors(R.GapTables(t))


@plan
def rate_changes(t):
    return history.rate_changes(t.rate_change_log)


@plan
def rate_intervals(t):
    return history.rate_intervals(t.rate_change_log)


@plan
def rate_intervals_events(t):
    return history.rate_intervals(t.event_change_log)


@plan
def entry_history(t):
    return history.entry_history(t.rate_change_log, t.attachment)


@plan
def missing_attachments(t):
    return history.missing_attachments(t.rate_change_log, t.attachment)


@plan
def entry_lineage(t):
    return history.entry_lineage(t)


@plan
def category_names(t):
    return lookups.category_names(t.business_category)


@plan
def category_options(t):
    return lookups.category_options(t.business_category)


@plan
def lookup_missing(t):
    ids = t.input("customer").select((F.col("c_custkey") + 1).alias("requested_id"))
    return lookups.lookup_missing(t.product_line, ids, "Product Line")


@plan
def sub_categories_by_category(t):
    return lookups.sub_categories_by_category(t.business_sub_category)


@plan
def active_product_lines(t):
    return lookups.active_product_lines(t.product_line)


@plan
def resolve_pl_code(t):
    return lookups.resolve_codes(t.product_line, R.add_line_requests(t).select("code").distinct())


@plan
def color_by_quarter(t):
    used = t.product_line.select(F.col("color_code_id").alias("id")).distinct()
    return lookups.color_by_quarter(t.color_code).join(used, "id", "left_semi")


@plan
def colors_of_quarters(t):
    return lookups.colors_of(t.color_code, R.asked_quarters(t))


@plan
def node_by_name(t):
    wanted = R.node_requests(t).select("level", "parent_id", "name").distinct()
    return lookups.nodes_by_name(lookups.all_nodes(t), wanted)


@plan
def l2_children(t):
    return lookups.l2_children(t.node_l3)


@plan
def entries_by_node(t):
    return lookups.entries_by_node(t.rate_entry)


@plan
def cell_rate(t):
    return lookups.cell_rate(t.rate_entry)


@plan
def product_line_detail(t):
    return lookups.product_line_detail(t)


@plan
def duplicate_cells(t):
    existing = lookups.entry_cells(t.rate_entry).select("level", "node_id", "product_line_id")
    return checks.duplicate_cells(existing.unionByName(R.requested_cells(t)))


@plan
def new_cells_only(t):
    return checks.new_cells_only(t.rate_entry, R.requested_cells(t))


@plan
def validate_requests(t):
    requests = R.mixed_requests(t)
    return checks.validate_requests(requests)


@plan
def orphan_entries(t):
    return hierarchy.orphan_entries(sheets.parse_rate_lines(R.sheet_lines(t)), t.product_line)


@plan
def tree_search(t):
    return hierarchy.tree_search(t, SEARCHES)


@plan
def column_tree(t):
    return hierarchy.column_tree(t)


@plan
def column_tree_plain(t):
    return hierarchy.column_tree(t, icons=False)


@plan
def row_tree(t):
    return hierarchy.row_tree(t)


@plan
def row_tree_cells(t):
    return hierarchy.row_tree_cells(t)


@plan
def category_tree_json(t):
    return hierarchy.category_tree_json(t)


@plan
def tree_search_table(t):
    """Every stretch of four characters that starts a word of a node's label is searched."""
    return hierarchy.tree_search_table(t, R.search_texts(t))


@plan
def row_tree_keys(t):
    return hierarchy.row_tree_keys(t)


@plan
def row_tree_pivot(t):
    return hierarchy.row_tree_pivot(t)


@plan
def group_tree_json(t):
    return hierarchy.group_tree_json(t)


@plan
def header_rows(t):
    return hierarchy.header_rows(t).drop("product_line_id")


@plan
def header_rows_json(t):
    return hierarchy.header_rows_json(t)


@plan
def column_tree_json(t):
    return hierarchy.column_tree_json(t)


@plan
def entry_detail_json(t):
    return history.entry_detail_json(t)


@plan
def header_spans(t):
    return hierarchy.header_spans(t)


@plan
def matrix_axes(t):
    return hierarchy.matrix_axes(t)


@plan
def pl_counts(t):
    return hierarchy.pl_counts(t)


@plan
def child_sum_violations(t):
    return checks.child_sum_violations(t)


@plan
def max_allowed_rate(t):
    return checks.max_allowed_rate(t)


@plan
def parent_rate_check(t):
    proposals = t.rate_entry.filter("l2_id IS NOT NULL").select(
        F.col("id").alias("rate_entry_id"), (F.col("rate") + F.lit("0.0300").cast("decimal(5,4)")).cast("decimal(18,4)").alias("new_rate")
    )
    return checks.parent_rate_check(t, proposals)


@plan
def quarter_labels(t):
    ts = F.col("o_orderdate")
    return t.input("orders").select(
        ts.alias("ts"),
        S.quarter_of(ts).alias("quarter"),
        S.month_range(S.quarter_of(ts)).alias("month_range"),
        S.quarter_name(S.quarter_of(ts)).alias("quarter_name"),
        S.base_rates_title(ts).alias("fy_title"),
        S.effective_title(ts, 1).alias("effective_title"),
        S.effective_title(ts, 1, wrap=True).alias("wrapped_title"),
    )


@plan
def clean_labels(t):
    return t.input("documents").select(F.col("doc_id").alias("id"), S.strip_quotes(F.col("text")).alias("label"))


@plan
def attachment_names(t):
    uploaded = F.lit("2024-05-15 10:20:00").cast("timestamp_ntz")
    original = F.col("original")
    return R.upload_names(t).select(
        original, S.stored_attachment_name(original, uploaded).alias("stored"), S.attachment_error(original).alias("error")
    )


@plan
def cookie_user(t):
    cookie = F.col("cookie")
    return R.cookies(t).select(cookie, S.cookie_user(cookie).alias("user_name"), S.cookie_error(cookie).alias("error"))


@plan
def parse_requests(t):
    return R.rate_request_texts(t).withColumn("r", S.rate_request(F.col("raw"))).select("raw", "r.rate", "r.note")


@plan
def import_rate_entries(t):
    return sheets.parse_rate_lines(R.sheet_lines(t))


@plan
def import_rate_rejects(t):
    return sheets.rate_line_rejects(R.broken_sheet_lines(t))


@plan
def upsert_product_lines(t):
    done = mutations.upsert_product_lines(t.product_line, R.add_line_requests(t))
    return done.select("req_id", "code", "outcome", "error", "id", "base_rate", "is_active")


@plan
def patch_product_lines(t):
    done = mutations.patch_product_lines(t.product_line, R.patch_line_requests(t))
    return done.select("id", "code", "base_rate", "outcome")


@plan
def soft_delete_product_lines(t):
    done = mutations.soft_delete_product_lines(t.product_line, R.delete_line_requests(t))
    return done.select("id", "code", "is_active")


@plan
def upsert_nodes(t):
    done = mutations.upsert_nodes(lookups.all_nodes(t), R.node_requests(t))
    return done.select("req_id", "level", "parent_id", "name", "outcome", "id")


@plan
def cascade_delete(t):
    nodes = lookups.all_nodes(t)
    return mutations.cascade_delete(nodes, R.delete_node_requests(t, nodes)).select("level", "id", "cascaded", "is_active_after")


@plan
def detached_entries(t):
    nodes = lookups.all_nodes(t)
    return mutations.detached_entries(t.rate_entry, mutations.cascade_delete(nodes, R.delete_node_requests(t, nodes)))


@plan
def rename_nodes(t):
    return mutations.rename_nodes(lookups.all_nodes(t), R.rename_requests(t))


@plan
def add_rate_entries(t):
    done = admission.add_rate_entries(t, R.add_rate_requests(t))
    return done.select("req_id", "outcome", "reason", "rate_entry_id")


@plan
def update_rate_entries(t):
    shown = lambda done: done.select("req_id", "outcome", "reason", "old_rate", "rate")
    return admission.update_rate_entries(t, R.update_rate_requests(t), shown)


@plan
def rate_rejections(t):
    """What the sum was and may be, for every rate that breaches it."""
    breaches = lambda done: done.filter("existing_total IS NOT NULL").select("req_id", *admission.SUMS)
    parts = {
        "update": admission.update_rate_entries(t, R.update_rate_requests(t), breaches),
        "add": admission.add_rate_entries(t, R.add_rate_requests(t)),
    }
    breached = [df.filter("existing_total IS NOT NULL").select(F.lit(kind).alias("kind"), "req_id", *admission.SUMS) for kind, df in parts.items()]
    return breached[0].unionByName(breached[1])


@plan
def change_log_append(t):
    updates = admission.update_rate_entries(t, R.update_rate_requests(t), admission.log_columns)
    adds = admission.add_rate_entries(t, R.add_rate_requests(t))
    return admission.change_log_rows(t.rate_change_log, updates, adds)


@plan
def rate_asof_after_updates(t):
    """As-of over the old and the appended log, for the updated entries."""
    before = t.rate_change_log
    updates = admission.update_rate_entries(t, R.update_rate_requests(t), admission.log_columns)
    of = portions(t.spark, scanned_bytes(before))
    appended = admission.change_log_rows(before, updates)
    appended = keep_tidy(appended.select("id", "rate_entry_id", "created_on", "rate"), "appended") if of > 1 else appended
    log = before.unionByName(appended, allowMissingColumns=True)
    touched = appended.select("rate_entry_id").distinct()  # a log row per accepted update

    def asof(number: int) -> DataFrame:
        own, changed = (portion(df, F.col("rate_entry_id"), number, of) for df in (log, touched))
        return history.rate_asof(own, "9999-12-31 00:00:00").join(changed, "rate_entry_id", "left_semi").select("rate_entry_id", "rate")

    return by_portion(t.spark, of, asof, "asof")


@plan
def audit_rows(t):
    nodes = lookups.all_nodes(t)
    lines = mutations.upsert_product_lines(t.product_line, R.add_line_requests(t))
    upserts = mutations.upsert_nodes(nodes, R.node_requests(t))
    deletes = mutations.delete_outcomes(nodes, R.delete_node_requests(t, nodes))
    patches = mutations.patch_outcomes(t.product_line, R.patch_line_requests(t))
    gone = mutations.line_delete_outcomes(t.product_line, R.delete_line_requests(t))
    renames = mutations.rename_outcomes(nodes, R.rename_requests(t))
    updates = admission.update_rate_entries(t, R.update_rate_requests(t), lambda done: done.select("outcome", "message"))
    adds = admission.add_rate_entries(t, R.add_rate_requests(t))
    day = F.expr(R.BATCH_DAY)
    return (
        mutations.audit_rows(lines, "/product-lines", "POST", at=day)
        .unionByName(mutations.audit_rows(patches, "/product-lines", "PATCH", at=day))
        .unionByName(mutations.audit_rows(gone, "/product-lines", "DELETE", at=day))
        .unionByName(mutations.audit_rows(upserts, "/nodes", "POST", at=day))
        .unionByName(mutations.audit_rows(renames, "/nodes", "PATCH", at=day))
        .unionByName(mutations.audit_rows(deletes, "/nodes", "DELETE", at=day))
        .unionByName(mutations.audit_rows(updates, "/rates", "PUT", at=day))
        .unionByName(mutations.audit_rows(adds, "/rates", "POST", at=day))
    )


@plan
def mutation_outcomes(t):
    """One row per request of the mutations whose own results are tables."""
    nodes = lookups.all_nodes(t)
    parts = {
        "patch_line": mutations.patch_outcomes(t.product_line, R.patch_line_requests(t)),
        "delete_line": mutations.line_delete_outcomes(t.product_line, R.delete_line_requests(t)),
        "rename": mutations.rename_outcomes(nodes, R.rename_requests(t)),
    }
    named = [df.select(F.lit(kind).alias("kind"), "req_id", "outcome", "error", "message") for kind, df in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])
