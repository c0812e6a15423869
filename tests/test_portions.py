"""Rate batches worked on in portions: the same rows, and no more on disk than one portion and the results."""

import os
import random

import pytest

from ratelattice.operators import admission, settling
from ratelattice.plans.queries import PLANS
from ratelattice.sources import kept
from tests.test_admission import ADDS, UPDATES
from tests.tiny import TinyTables, day, entry, line, nodes, rate


def folders(spark):
    top = kept.shared_folder(spark).removeprefix("file:")
    return {name for name in os.listdir(top) if name.startswith("kept-")}


def stored(spark, tmp_path, name, schema, rows):
    """Rows in a file, as portions are by the size of files."""
    path = str(tmp_path / name)
    spark.createDataFrame([tuple(row.get(c.split()[0]) for c in schema.split(", ")) for row in rows], schema.replace("decimal(18, 4)", "decimal(18,4)")).write.parquet(path)
    return spark.read.parquet(path)


def batch(spark, tmp_path):
    rng = random.Random(3)
    parents = {i: 1 + i % 3 for i in range(1, 10)}
    entries = [entry(10 * pl + l2, pl, "0.3", l2=l2) for pl in (1, 2, 3) for l2 in (1, 2)]
    entries += [entry(100 * pl + l3, pl, "0.05", l3=l3) for pl in (1, 2, 3) for l3 in (1, 2, 3, 4)]
    t = TinyTables(spark, product_line=[line(i) for i in (1, 2, 3)], node_l3=nodes(*[(i, p, f"D{i}", 1) for i, p in parents.items()]), rate_entry=entries)
    ids = [e["id"] for e in entries] + [9999, None]
    updates = [{"req_id": i, "req_ts": day(rng.randint(0, 5)), "rate_entry_id": rng.choice(ids), "rate": rate(round(rng.uniform(0, 0.3), 2)), "note": "n", "attachment_id": 1} for i in range(200)]
    adds = [{"req_id": i, "req_ts": day(rng.randint(0, 5)), "rate": rate(round(rng.uniform(0, 0.2), 2)), "l2_id": rng.choice([None, None, 3]), "l3_id": rng.choice([None, 5, 6, 8, 99]), "product_line_name": rng.choice(["PL1", "PL2", "PL3", "none"])} for i in range(100)]
    return t, stored(spark, tmp_path, "updates", UPDATES, updates), stored(spark, tmp_path, "adds", ADDS, adds)


def test_portions_give_the_same_rows(spark, tmp_path):
    t, updates, adds = batch(spark, tmp_path)
    whole = [sorted(map(repr, df.collect())) for df in (admission.update_rate_entries(t, updates), admission.add_rate_entries(t, adds))]
    spark.conf.set(kept.PORTION_BYTES, "3000")
    try:
        parts = kept.portions(spark, admission.scanned_bytes(updates))
        done = [admission.update_rate_entries(t, updates), admission.add_rate_entries(t, adds)]
        assert parts > 1 and [sorted(map(repr, df.collect())) for df in done] == whole
    finally:
        spark.conf.unset(kept.PORTION_BYTES)


def test_ordinary_families_are_judged_without_being_written_again(spark, tmp_path, monkeypatch):
    t, updates, _ = batch(spark, tmp_path)
    written, keep = [], settling.keep
    monkeypatch.setattr(settling, "keep", lambda df, name: written.append(name) or keep(df, name))
    assert admission.update_rate_entries(t, updates).filter("outcome = 'UPDATE'").count() > 0
    assert not written


def test_a_portion_leaves_only_its_result(spark):
    before = folders(spark)
    done = kept.by_portion(spark, 3, lambda number: kept.keep(spark.range(9), "inner").filter(f"id % 3 = {number}"), "result")
    assert len(folders(spark) - before) == 3 and sorted(r[0] for r in done.collect()) == list(range(9))
    assert kept.portions(spark, kept.UNKNOWN_BYTES) == 1 and kept.portions(spark, 1 << 50) == kept.MOST_PORTIONS


@pytest.mark.parametrize(("name", "read"), [
    ("entry_detail_json", {"documents"}), ("rate_asof_after_updates", {"asof"}), ("change_log_append", {"updated", "add_judged"}), ("rate_rejections", {"updated", "add_judged"}),
])
def test_queries_in_portions(spark, tables, name, read):
    """The results come from tables kept portion by portion, and are those of the whole."""
    whole = sorted(map(repr, PLANS[name](tables).collect()))
    spark.conf.set(kept.PORTION_BYTES, "50000")
    try:
        done = PLANS[name](tables)
        assert {file.split("/kept-")[1].split("/")[1] for file in done.inputFiles() if "/kept-" in file} >= read
        assert sorted(map(repr, done.collect())) == whole
    finally:
        spark.conf.unset(kept.PORTION_BYTES)
