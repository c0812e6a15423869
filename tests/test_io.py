"""Sources, sinks and the streamed form."""

import csv
import json

from ratelattice.operators import admission, hierarchy, matrix
from ratelattice.plans.requests import update_rate_requests
from ratelattice.sources import sheets, sinks
from ratelattice.sources.tables import STORED, StoredTables, open_tables, store_tables
from ratelattice.streaming.apply import read_requests, stream_updates
from tests.conftest import SF
from tests.tiny import TinyTables, categories, entry, line, nodes, rate, rows


def test_sheet(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow("abcdefghi")
        out.writerow(["1", "2024-01-02T03:04:05", "me", "a, b", "4", "", "6", "0.25", ""])
        out.writerow(["2.0", "2024-01-02T03:04:05", "me", "n", "4", "5", "6", "7", "8"])
    df = sheets.read_rate_sheet(spark, str(path)).orderBy("id")
    assert rows(df, "id", "note", "l2_id", "l3_id", "product_line_id", "rate") == [
        (1, "a, b", 4, None, 6, rate("0.25")), (2, "n", 8, 5, 6, rate(7)),
    ]


def test_sheet_rejects_name_every_lost_cell(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow("abcdefghi")
        out.writerow(["1", "2024-01-02T03:04:05", "me", "two\nlines", "4", "", "6", "0.25", ""])
        out.writerow(["x", "2024-01-32", "me", "n", "4.5", "5", "99999999999999999999999", "1,5", "8"])
        out.writerow(["", "", "", "", "", "", "", "", ""])
        out.writerow(["3", "2024-01-02T03:04:05"])
        out.writerow(["4", "2024-01-02T03:04:05", "me", "n", "", "1", "1", "0.1", "", "more"])
    read = sheets.read_rate_sheet(spark, str(path), line_breaks=True)
    assert rows(read.filter("id = 1"), "id", "note", "rate") == [(1, "two\nlines", rate("0.25"))]
    found = sheets.read_rate_sheet_rejects(spark, str(path), line_breaks=True)
    assert sorted(map(repr, rows(found, "cell", "value", "reason"))) == sorted(map(repr, [
        ("c0", "x", "BAD_NUMBER"), ("c1", "2024-01-32", "BAD_DATE"), ("c4", "4.5", "BAD_NUMBER"), ("c6", "99999999999999999999999", "BAD_NUMBER"),
        ("c7", "1,5", "BAD_NUMBER"), ("c0", None, "MISSING"), ("c7", None, "MISSING"), ("row", None, "SHORT_ROW"), ("row", None, "LONG_ROW"),
    ]))


def test_stored_tables_give_the_same_answers(spark, tables, tmp_path):
    folder = str(tmp_path / "stored")
    store_tables(tables, folder)
    stored = open_tables(spark, folder, SF)
    assert isinstance(stored, StoredTables)
    for name in STORED:
        assert sorted(map(repr, getattr(stored, name).collect())) == sorted(map(repr, getattr(tables, name).collect()))
    assert sorted(matrix.rate_matrix_asof(stored).collect()) == sorted(matrix.rate_matrix_asof(tables).collect())


def test_matrix_export_and_append(spark, tables, tmp_path):
    cells = matrix.rate_matrix_asof(tables)
    for fmt in ("parquet", "csv"):
        sinks.export_matrix(cells, str(tmp_path / fmt), fmt)
        back = spark.read.option("header", True).format(fmt).load(str(tmp_path / fmt))
        assert back.count() == cells.count()
    for _ in range(2):
        sinks.append_audit(spark.range(3), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 6


def test_json_documents(spark, tmp_path):
    t = TinyTables(
        spark, business_category=categories(1), group_node=nodes((1, 1, "G", 1), parent="business_category_id"),
        node_l1=nodes((1, 1, "A", 1)), node_l2=nodes((1, 1, "B", 1)), product_line=[line(1)], rate_entry=[entry(1, 1, "0.1", l2=1)],
    )
    sinks.write_json_documents(hierarchy.group_tree_json(t), str(tmp_path / "docs"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "docs")).collect()]
    assert sorted(json.loads(text)["key"] for text in lines) == [1, 2, 3, 4, 5, 6]


def test_streamed_updates_equal_one_batch(spark, tables, tmp_path):
    requests = update_rate_requests(tables).select("req_id", "req_ts", "rate_entry_id", "rate", "note", "attachment_id")
    source, target = str(tmp_path / "requests"), str(tmp_path / "out")
    # two files, the later requests written last, so that the micro-batches keep the order of the one batch
    for half in ("req_ts < '1998-01-01'", "req_ts >= '1998-01-01'"):
        requests.filter(half).coalesce(1).write.mode("append").parquet(source)
    query = stream_updates(tables, read_requests(spark, source), target, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    streamed = spark.read.schema("req_id bigint, outcome string, reason string").parquet(f"{target}/outcomes")
    batch = admission.update_rate_entries(tables, requests)
    assert sorted(map(repr, streamed.select("req_id", "outcome", "reason").collect())) == sorted(
        map(repr, batch.select("req_id", "outcome", "reason").collect())
    )
    state = spark.read.parquet(f"{target}/rate_entry/version=1")
    expected = admission.apply_rate_updates(tables.rate_entry, batch)
    assert sorted(rows(state, "id", "rate")) == sorted(rows(expected, "id", "rate"))
