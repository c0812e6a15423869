"""Batches of rate requests against a plain sequential replay."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratelattice.operators import admission, checks, history, settling
from tests.tiny import TinyTables, day, entry, frame, line, nodes, rate, rows

UPDATES = "req_id bigint, req_ts timestamp_ntz, rate_entry_id bigint, rate decimal(18,4), note string, attachment_id int"
ADDS = "req_id bigint, req_ts timestamp_ntz, rate decimal(18,4), l2_id int, l3_id bigint, product_line_name string"


def updates(spark, *requests):
    return frame(spark, UPDATES, [{"note": "n", "attachment_id": 1, "req_ts": day(0), **r} for r in requests])


def adds(spark, *requests):
    return frame(spark, ADDS, [{"req_ts": day(0), **r} for r in requests])


def one_family(spark, parent="0.10", children=("0.04", None)):
    entries = [entry(100 + i, 1, r, l3=i) for i, r in enumerate(children, 1) if r is not None]
    if parent is not None:
        entries.append(entry(50, 1, parent, l2=1))
    return TinyTables(
        spark, product_line=[line(1)], node_l2=nodes((1, 1, "B", 1)),
        node_l3=nodes(*[(i, 1, f"D{i}", 1) for i in range(1, len(children) + 1)]), rate_entry=entries,
    )


def outcome(df, column="req_id"):
    return {r[column]: (r["outcome"], r["reason"]) for r in df.collect()}


def test_equal_sum_is_accepted_and_breach_is_not(spark):
    t = one_family(spark)
    got = outcome(admission.add_rate_entries(t, adds(spark, {"req_id": 1, "rate": rate("0.06"), "l3_id": 2, "product_line_name": "PL1"})))
    assert got == {1: ("INSERT", None)}
    got = outcome(admission.add_rate_entries(t, adds(spark, {"req_id": 1, "rate": rate("0.07"), "l3_id": 2, "product_line_name": "PL1"})))
    assert got == {1: ("REJECT", "CHILD_SUM_EXCEEDED")}
    t = one_family(spark, children=("0.04",))
    room = checks.max_allowed_rate(t)
    assert rows(room, "existing_total", "max_value_allowed") == [(rate(0), rate("0.10"))]


def test_own_rate_does_not_count(spark):
    t = one_family(spark, children=("0.05", "0.04"))
    got = outcome(admission.update_rate_entries(t, updates(spark, {"req_id": 1, "rate_entry_id": 101, "rate": rate("0.06")})))
    assert got == {1: ("UPDATE", None)}


def test_parent_rate_missing(spark):
    t = one_family(spark, parent=None)
    got = outcome(admission.add_rate_entries(t, adds(spark, {"req_id": 1, "rate": rate("0.01"), "l3_id": 2, "product_line_name": "PL1"})))
    assert got == {1: ("REJECT", "PARENT_RATE_MISSING")}
    got = outcome(admission.update_rate_entries(t, updates(spark, {"req_id": 1, "rate_entry_id": 101, "rate": rate("0.01")}, {"req_id": 2, "rate_entry_id": 101, "rate": rate("0.04")})))
    assert got == {1: ("REJECT", "PARENT_RATE_MISSING"), 2: ("REJECT", "NO_CHANGE")}


def test_rejected_requests_leave_no_trace(spark):
    t = one_family(spark, children=(None, None, None))
    batch = adds(
        spark,
        {"req_id": 1, "rate": rate("0.08"), "l3_id": 1, "product_line_name": "PL1"},
        {"req_id": 2, "rate": rate("0.05"), "l3_id": 2, "product_line_name": "PL1"},
        {"req_id": 3, "rate": rate("0.02"), "l3_id": 3, "product_line_name": "PL1"},
    )
    done = admission.add_rate_entries(t, batch)
    assert outcome(done) == {1: ("INSERT", None), 2: ("REJECT", "CHILD_SUM_EXCEEDED"), 3: ("INSERT", None)}
    assert sorted(rows(done.filter("rate_entry_id IS NOT NULL"), "req_id", "rate_entry_id")) == [(1, 51), (3, 52)]
    after = TinyTables(spark)
    after.__dict__.update(node_l3=t.node_l3, rate_entry=admission.apply_rate_adds(t.rate_entry, done))
    assert checks.child_sum_violations(after).count() == 0


def test_no_change_and_static_rejects(spark):
    t = one_family(spark)
    got = outcome(
        admission.update_rate_entries(
            t,
            updates(
                spark,
                {"req_id": 1, "rate_entry_id": 50, "rate": rate("0.1000")},
                {"req_id": 2, "rate_entry_id": 999, "rate": rate("0.1")},
                {"req_id": 3, "rate_entry_id": 50, "rate": rate("-1")},
                {"req_id": 4, "rate_entry_id": 50, "rate": None},
                {"req_id": 5, "rate_entry_id": 50, "rate": rate("0.2"), "note": " "},
                {"req_id": 6, "rate_entry_id": 50, "rate": rate("0.03")},
                {"req_id": 7, "rate_entry_id": 50, "rate": rate("0.04")},
            ),
        )
    )
    assert got == {
        1: ("REJECT", "NO_CHANGE"), 2: ("REJECT", "NOT_FOUND"), 3: ("REJECT", "RATE_NEGATIVE"), 4: ("REJECT", "RATE_MISSING"),
        5: ("REJECT", "NOTE_BLANK"), 6: ("REJECT", "BELOW_CHILD_SUM"), 7: ("UPDATE", None),
    }


def replay_updates(entries, parents, requests):
    entries = {e["id"]: dict(e) for e in entries}
    out = {}
    for r in sorted(requests, key=lambda r: (r["req_ts"], r["req_id"])):
        e = entries.get(r["rate_entry_id"])
        reason = None
        if e is None:
            reason = "NOT_FOUND"
        elif e["rate"] == r["rate"]:
            reason = "NO_CHANGE"
        else:
            def children(l2, skip=None):
                return sum((c["rate"] for c in entries.values() if c["l3_id"] and parents[c["l3_id"]] == l2 and c["product_line_id"] == e["product_line_id"] and c["id"] != skip), Decimal(0))

            if e["l3_id"] is not None:
                l2 = parents[e["l3_id"]]
                limit = [p["rate"] for p in entries.values() if p["l2_id"] == l2 and p["product_line_id"] == e["product_line_id"]]
                if not limit:
                    reason = "PARENT_RATE_MISSING"
                elif children(l2, e["id"]) + r["rate"] > limit[0]:
                    reason = "CHILD_SUM_EXCEEDED"
            if reason is None and e["l2_id"] is not None and children(e["l2_id"]) > r["rate"]:
                reason = "BELOW_CHILD_SUM"
        if reason is None:
            e["rate"] = r["rate"]
        out[r["req_id"]] = ("UPDATE" if reason is None else "REJECT", reason)
    return out, {i: e["rate"] for i, e in entries.items()}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("split", [False, True])
def test_random_updates(spark, request, seed, split):
    if split:
        request.getfixturevalue("chunking")
        request.getfixturevalue("monkeypatch").setattr(settling, "ROUNDS", 2)
    rng = random.Random(seed)
    parents = {i: 1 + i % 4 for i in range(1, 17)}
    entries, next_id = [], 1
    for pl in (1, 2, 3):
        for l2 in range(1, 5):
            if rng.random() < 0.8:
                entries.append(entry(next_id, pl, round(rng.uniform(0, 0.4), 2), l2=l2))
                next_id += 1
        for l3 in parents:
            roll = rng.random()
            if roll < 0.7:
                entries.append(entry(next_id, pl, round(rng.uniform(0, 0.15), 2), l3=l3))
                next_id += 1
    entries.append(entry(next_id, 4, "0.3", l2=1, l3=4))
    entries.append(entry(next_id + 1, 5, "0.3", l2=2, l3=1))
    entries.append(entry(next_id + 2, 5, "0.3", l2=2, l3=2))
    entries.append(entry(next_id + 3, 6, "0.3"))
    t = TinyTables(spark, product_line=[line(i) for i in range(1, 7)], node_l3=nodes(*[(i, p, f"D{i}", 1) for i, p in parents.items()]), rate_entry=entries)
    # a third of the requests hits one entry
    ids = [e["id"] for e in entries] + [9999, next_id + 3]
    requests = [
        {"req_id": i, "req_ts": day(rng.randint(0, 20)), "rate_entry_id": entries[0]["id"] if i % 3 == 0 else rng.choice(ids), "rate": rate(round(rng.uniform(0, 0.4), 2 if i % 2 else 1))}
        for i in range(400)
    ]
    expected, after = replay_updates(entries, parents, requests)
    done = admission.update_rate_entries(t, updates(spark, *requests))
    assert outcome(done) == expected
    state = admission.apply_rate_updates(t.rate_entry, done)
    assert dict(rows(state, "id", "rate")) == after
    log = admission.change_log_rows(t.rate_change_log, updates=done)
    assert log.schema == t.rate_change_log.schema or log.columns == t.rate_change_log.columns
    accepted = sorted((r["req_ts"], r["req_id"]) for r in done.filter("outcome = 'UPDATE'").collect())
    numbered = sorted((r["id"], r["created_on"], r["rate_entry_id"]) for r in log.collect())
    assert [n for n, _, _ in numbered] == list(range(1, len(accepted) + 1)) and [ts for _, ts, _ in numbered] == [ts for ts, _ in accepted]
    # appended to the log, the changes give the state that was applied
    asof = dict(rows(history.rate_asof(log, "9999-01-01 00:00:00"), "rate_entry_id", "rate"))
    assert asof == {e: after[e] for e in asof} and len(accepted) == sum(o == "UPDATE" for o, _ in expected.values())


def replay_adds(entries, parents, known, requests):
    cells2 = {(e["l2_id"], e["product_line_id"]): e["rate"] for e in entries if e["l2_id"]}
    cells3 = {(e["l3_id"], e["product_line_id"]): e["rate"] for e in entries if e["l3_id"]}
    at_start, out = set(cells3), {}
    for r in sorted(requests, key=lambda r: (r["req_ts"], r["req_id"])):
        pl, l2, l3, reason = known.get(r["product_line_name"]), r.get("l2_id"), r.get("l3_id"), None
        if pl is None:
            reason = "LINE_NOT_FOUND"
        elif l3 is not None and (l3, pl) in at_start:
            reason = "CELL_EXISTS"
        elif l3 is not None and l3 not in parents:
            reason = "NODE_NOT_FOUND"
        elif l3 is not None and (l3, pl) in cells3:
            reason = "CELL_EXISTS"
        elif l3 is not None and (parents[l3], pl) not in cells2:
            reason = "PARENT_RATE_MISSING"
        elif l3 is not None and sum((v for (n, p), v in cells3.items() if p == pl and parents[n] == parents[l3]), Decimal(0)) + r["rate"] > cells2[parents[l3], pl]:
            reason = "CHILD_SUM_EXCEEDED"
        elif l2 is not None and (l2, pl) in cells2:
            reason = "CELL_EXISTS"
        if reason is None:
            if l3 is not None:
                cells3[l3, pl] = r["rate"]
            if l2 is not None:
                cells2[l2, pl] = r["rate"]
        out[r["req_id"]] = ("INSERT" if reason is None else "REJECT", reason)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_random_adds(spark, seed):
    rng = random.Random(seed)
    parents = {i: 1 + i % 5 for i in range(1, 21)}
    entries = [entry(1, 1, "0.3", l2=1), entry(2, 1, "0.05", l3=5), entry(3, 2, "5", l2=2), entry(4, 2, "0.1", l2=3)]
    known = {f"PL{i}": i for i in (1, 2, 3)}
    t = TinyTables(spark, product_line=[line(i, active=i % 2) for i in (1, 2, 3)], node_l3=nodes(*[(i, p, f"D{i}", 1) for i, p in parents.items()]), rate_entry=entries)
    requests = []
    for i in range(400):
        roll = rng.random()
        l2 = rng.randint(1, 5) if roll > 0.8 else None
        l3 = rng.randint(1, 21) if roll < 0.85 else None
        requests.append({"req_id": i, "req_ts": day(rng.randint(0, 9)), "rate": rate(round(rng.uniform(0, 0.3), 2)), "l2_id": l2, "l3_id": l3, "product_line_name": rng.choice(["PL1", "PL1", "PL2", "PL3", "none"])})
    done = admission.add_rate_entries(t, adds(spark, *requests))
    assert outcome(done) == replay_adds(entries, parents, known, requests)
    ids = [r[0] for r in rows(done.filter("outcome = 'INSERT'").orderBy("req_ts", "req_id"), "rate_entry_id")]
    assert ids == list(range(5, 5 + len(ids)))


def test_request_without_a_node_adds_a_loose_entry(spark):
    t = one_family(spark)
    done = admission.add_rate_entries(t, adds(spark, {"req_id": 1, "rate": rate("9"), "product_line_name": "PL1"}))
    assert outcome(done) == {1: ("INSERT", None)}


def test_accepted_updates_add_no_violation(spark, tables):
    from ratelattice.plans.requests import update_rate_requests

    before = checks.child_sum_violations(tables).select("l2_id", "product_line_id")
    done = admission.update_rate_entries(tables, update_rate_requests(tables))
    after = TinyTables(spark)
    after.__dict__.update(node_l3=tables.node_l3, rate_entry=admission.apply_rate_updates(tables.rate_entry, done))
    broken = checks.child_sum_violations(after).select("l2_id", "product_line_id")
    assert broken.join(before, ["l2_id", "product_line_id"], "left_anti").count() == 0
    assert done.select(F.countDistinct("reason")).first()[0] >= 4


def spanning_entries(spark, rng):
    """Two lines over three families, with entries that are a child in one and the parent of another."""
    parents = {1: 1, 2: 1, 3: 2, 4: 2, 5: 3, 6: 3}
    entries = []
    for pl in (1, 2):
        for l2, l3 in ((1, 3), (2, 5), (3, None)):  # 1 <- 2 <- 3: a chain of families
            entries.append(entry(len(entries) + 1, pl, round(rng.uniform(0.1, 0.5), 2), l2=l2, l3=l3))
        for l3 in (1, 2, 4, 6):
            entries.append(entry(len(entries) + 1, pl, round(rng.uniform(0, 0.2), 2), l3=l3))
    t = TinyTables(spark, product_line=[line(1), line(2)], node_l3=nodes(*[(i, p, f"D{i}", 1) for i, p in parents.items()]), rate_entry=entries)
    return parents, entries, t


@pytest.mark.parametrize("rounds", [1, 12])
def test_updates_that_span_families(spark, monkeypatch, rounds):
    """One round leaves most requests to the fold, many leave next to none."""
    monkeypatch.setattr(settling, "ROUNDS", rounds)
    rng = random.Random(7)
    parents, entries, t = spanning_entries(spark, rng)
    # a third of the requests hits one family
    requests = [
        {"req_id": i, "req_ts": day(rng.randint(0, 30)), "rate_entry_id": rng.choice([1, 4, 5]) if i % 3 == 0 else rng.randint(1, len(entries)), "rate": rate(round(rng.uniform(0, 0.5), 2))}
        for i in range(150)
    ]
    expected, after = replay_updates(entries, parents, requests)
    done = admission.update_rate_entries(t, updates(spark, *requests))
    assert outcome(done) == expected and {reason for _, reason in expected.values()} >= {None, "CHILD_SUM_EXCEEDED", "BELOW_CHILD_SUM"}
    assert dict(rows(admission.apply_rate_updates(t.rate_entry, done), "id", "rate")) == after


@pytest.mark.parametrize("rounds", [1, 12])
def test_adds_that_span_families(spark, monkeypatch, rounds):
    monkeypatch.setattr(settling, "ROUNDS", rounds)
    rng = random.Random(11)
    parents = {i: 1 + i % 5 for i in range(1, 21)}
    entries = [entry(1, 1, "0.6", l2=1), entry(2, 1, "0.05", l3=5)]
    t = TinyTables(spark, product_line=[line(1)], node_l3=nodes(*[(i, p, f"D{i}", 1) for i, p in parents.items()]), rate_entry=entries)
    requests = [
        {"req_id": i, "req_ts": day(rng.randint(0, 9)), "rate": rate(round(rng.uniform(0, 0.3), 2)), "l2_id": rng.choice([None, 2, 3, 4, 5]), "l3_id": rng.randint(1, 20), "product_line_name": "PL1"}
        for i in range(100)
    ]
    expected = replay_adds(entries, parents, {"PL1": 1}, requests)
    done = admission.add_rate_entries(t, adds(spark, *requests))
    assert outcome(done) == expected
    spanning = [r for r in requests if r["l2_id"] and parents[r["l3_id"]] != r["l2_id"] and expected[r["req_id"]][0] == "INSERT"]
    assert spanning


def test_breached_sums_are_reported(spark):
    t = one_family(spark, children=("0.05", "0.04"))
    done = admission.update_rate_entries(t, updates(spark, {"req_id": 1, "rate_entry_id": 101, "rate": rate("0.07")}, {"req_id": 2, "rate_entry_id": 50, "rate": rate("0.01")}))
    assert sorted(rows(done, "req_id", "reason", *admission.SUMS)) == [
        (1, "CHILD_SUM_EXCEEDED", rate("0.04"), rate("0.11"), rate("0.06")), (2, "BELOW_CHILD_SUM", None, None, None),
    ]


def test_components(spark):
    from ratelattice.operators.components import connected

    edges = [(i, i + 1) for i in range(1, 40)] + [(50, 51), (52, 51), (60, 60), (None, 3)]
    got = dict(rows(connected(spark.createDataFrame(edges, "a bigint, b bigint")), "node", "component"))
    assert got == {**{i: 1 for i in range(1, 41)}, 50: 50, 51: 50, 52: 50, 60: 60}
