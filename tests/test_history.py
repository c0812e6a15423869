"""As-of values, intervals, history and lineage on hand-written tables."""

import datetime as dt

from pyspark.sql import functions as F

from ratelattice.operators import history, matrix
from tests.tiny import TinyTables, categories, change, day, entry, frame, line, nodes, rate, rows


def log(spark, *changes):
    return TinyTables(spark, rate_change_log=list(changes)).rate_change_log


def test_change_at_the_moment_counts(spark):
    df = history.rate_asof(log(spark, change(1, 1, 0, "0.1"), change(2, 1, 5, "0.2")), "2024-01-06 00:00:00")
    assert rows(df, "rate_entry_id", "rate") == [(1, rate("0.2"))]


def test_no_change_by_then(spark):
    assert history.rate_asof(log(spark, change(1, 1, 5, "0.1")), "2024-01-02 00:00:00").count() == 0


def test_tie_takes_the_higher_log_id(spark):
    changes = log(spark, change(2, 1, 0, "0.2"), change(9, 1, 0, "0.9"), change(3, 1, 0, "0.3"))
    assert rows(history.rate_asof(changes, "2024-02-01 00:00:00"), "rate") == [(rate("0.9"),)]
    intervals = history.rate_intervals(changes).filter("valid_to IS NULL OR valid_to > valid_from")
    assert rows(intervals, "rate", "valid_to") == [(rate("0.9"), None)]


def test_interval_join_equals_asof(tables):
    t = "1998-06-30 23:59:00"
    moment = history.moment(t)
    intervals = history.rate_intervals(tables.rate_change_log).filter(
        (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (moment < F.col("valid_to")))
    )
    direct = history.rate_asof(tables.rate_change_log, t)
    assert sorted(rows(intervals, "rate_entry_id", "rate")) == sorted(rows(direct, "rate_entry_id", "rate"))


def test_several_moments_equal_single_ones(tables):
    moments = ["1992-01-01 00:00:00", "1995-12-31 23:59:00", "1998-06-30 23:59:00", "2030-01-01 00:00:00"]
    multi = history.rate_asof_multi(tables.rate_change_log, moments)
    for m in moments:
        single = history.rate_asof(tables.rate_change_log, m)
        part = multi.filter(F.col("as_of") == history.moment(m))
        assert sorted(rows(part, "rate_entry_id", "rate")) == sorted(rows(single, "rate_entry_id", "rate"))


def test_old_rates_form_a_chain(tables):
    changes = rows(history.rate_changes(tables.rate_change_log), "rate_entry_id", "old_rate", "rate")
    stored = rows(tables.rate_change_log, "rate_entry_id", "old_rate", "rate")
    assert sorted(changes) == sorted(stored)


def test_history_shows_old_rate_newest_first(spark):
    t = TinyTables(
        spark,
        rate_change_log=[change(1, 7, 0, "0.1"), change(2, 7, 3, "0.2", "0.1"), {**change(3, 7, 4, "0.3", "0.2"), "attachment_id": 5}],
        attachment=[{"id": 1, "path": "a.pdf"}],
    )
    df = history.entry_history(t.rate_change_log, t.attachment).orderBy("seq")
    assert rows(df, "seq", "date", "base_rate", "attachment") == [
        (1, "01/04/2024 00:00", rate("0.1"), "a.pdf"),
        (2, "01/01/2024 00:00", rate("0.1"), "a.pdf"),
    ]
    assert rows(history.missing_attachments(t.rate_change_log, t.attachment), "log_id") == [(3,)]


def family(spark, **extra):
    base = dict(
        business_category=categories(1),
        business_sub_category=[{"id": 1, "business_category_id": 1, "name": "S1", "is_active": 1}],
        product_line=[line(1), line(2, active=0)],
        group_node=nodes((1, 1, "G", 1), parent="business_category_id"),
        node_l1=nodes((1, 1, "L1", 1)),
        node_l2=nodes((1, 1, "L2", 1), (2, 1, "L2 off", 0)),
        node_l3=nodes((1, 1, "L3", 1), (2, 2, "below off", 1)),
    )
    return TinyTables(spark, **{**base, **extra})


def test_lineage(spark):
    t = family(spark, rate_entry=[entry(1, 1, "0.1", l2=1), entry(2, 1, "0.1", l3=1), entry(3, 1, "0.1", l2=1, l3=1), entry(4, 1, "0.1")])
    df = history.entry_lineage(t).orderBy("rate_entry_id")
    assert rows(df, "rate_entry_id", "category", "group_name", "product_line", "seller") == [
        (1, "C1", "L1", "PL1", "L2"),
        (2, "C1", "L1", "PL1", "L3"),
        (3, "C1", None, "PL1", None),
        (4, "C1", None, "PL1", None),
    ]


def test_matrix_edges(spark):
    t = family(
        spark,
        rate_entry=[
            entry(1, 1, "0.1", l2=1), entry(2, 1, "0.1", l3=1), entry(3, 2, "0.1", l3=1), entry(4, 1, "0.1", l3=2),
            entry(5, 1, "0.1", l2=2), entry(6, 1, "0.1"),
        ],
        rate_change_log=[change(1, 1, 0, "0.04"), change(2, 2, 90, "0.05")],
    )
    df = matrix.rate_matrix_asof(t, "2024-01-10 00:00:00").orderBy("row_no")
    # rows: 5 group, 6 level 1, 7 level 2, 8 level 3; inactive nodes and lines have no place
    assert rows(df, "row_no", "col_no", "level", "node_id", "rate") == [(7, 1, 2, 1, "0.0400"), (8, 1, 3, 1, "")]


def test_entry_on_both_levels_shows_twice(spark):
    t = family(spark, rate_entry=[entry(1, 1, "0.1", l2=1, l3=1)], rate_change_log=[change(1, 1, 0, "0.1")])
    assert matrix.rate_matrix_asof(t, "2024-02-01 00:00:00").count() == 2


def test_day_helper():
    assert day(1) - day(0) == dt.timedelta(days=1)


def test_probes_see_the_last_change_by_their_time(spark):
    log = TinyTables(spark, rate_change_log=[change(1, 7, 1, "0.1"), change(2, 7, 3, "0.2"), change(3, 7, 3, "0.3"), change(4, 8, 2, "0.4")]).rate_change_log
    probes = frame(
        spark,
        "probe_id bigint, rate_entry_id bigint, as_of timestamp_ntz",
        [{"probe_id": i, "rate_entry_id": e, "as_of": day(n)} for i, e, n in ((1, 7, 0), (2, 7, 1), (3, 7, 2), (4, 7, 3), (5, 8, 9), (6, 9, 9))],
    )
    got = sorted(rows(history.rate_asof_probes(log, probes), "probe_id", "rate"))
    assert got == [(1, None), (2, rate("0.1")), (3, rate("0.1")), (4, rate("0.3")), (5, rate("0.4")), (6, None)]


def test_broken_lineages_are_listed(spark):
    t = TinyTables(
        spark,
        business_category=categories(1),
        business_sub_category=[{"id": 1, "business_category_id": 1, "name": "S", "is_active": 1}, {"id": 2, "business_category_id": 9, "name": "T", "is_active": 1}],
        product_line=[line(1), line(2, sub=5), line(3, sub=2)],
        node_l1=nodes((1, 1, "A", 1)),
        node_l2=nodes((1, 1, "B", 1), (2, 8, "C", 1)),
        node_l3=nodes((1, 1, "D", 1), (2, 7, "E", 1)),
        rate_entry=[
            entry(1, 1, "0.1", l2=1), entry(2, 1, "0.1", l2=2), entry(3, 1, "0.1", l2=6), entry(4, 1, "0.1", l3=2), entry(5, 1, "0.1", l3=4),
            entry(6, 2, "0.1", l3=1), entry(7, 3, "0.1", l3=1), entry(8, 4, "0.1", l2=1),
        ],
    )
    assert sorted(rows(history.lineage_errors(t), "rate_entry_id", "missing", "missing_id")) == [
        (2, "level_1", 8), (3, "level_2", 6), (4, "level_2", 7), (5, "level_3", 4), (6, "sub_category", 5), (7, "category", 9), (8, "product_line", 4),
    ]
    assert {r["rate_entry_id"] for r in history.entry_lineage(t).collect()} == {1}
