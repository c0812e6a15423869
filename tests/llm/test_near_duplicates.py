import numpy as np
import pytest

from ratelattice.llm import common, setsketch

from .tinydocs import ODD, changed, documents, sentence


def brute(rows, words, num, den):
    sets = []
    for _, text in rows:
        tokens = (text or "").encode().lower().split()
        w = min(words, len(tokens))
        sets.append({tuple(tokens[i : i + w]) for i in range(len(tokens) - w + 1)} if tokens else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and den * len(a & b) >= num * len(a | b):
                x, y = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                root[y] = x
    return sorted((r[0], len(s), rows[find(i)][0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)) if r[0] is not None)


@pytest.mark.parametrize(("words", "num"), [(3, 85), (5, 80)])
def test_matches_brute_force(spark, words, num):
    base, other = sentence(1, 120), sentence(2, 40)
    rows = [(i + 1, changed(base, i, i % 9)) for i in range(60)] + [(200 + i, changed(other, i, i % 4)) for i in range(30)]
    rows += [(300 + i, sentence(i, 50)) for i in range(20)] + [(400, base), (401, base.upper()), (402, f" {base}\n")] + [r for r in ODD if r[0] != 104]
    rows += [(500 + i, sentence(77, 60) + " " + sentence(600 + i, 25)) for i in range(25)]
    got = setsketch.near_duplicates(documents(spark, rows), words, num, 100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == brute(rows, words, num, 100)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len(got) == len(rows)


def test_empty_table_and_repeated_rows(spark):
    assert setsketch.near_duplicates(documents(spark, [])).collect() == []
    got = setsketch.near_duplicates(documents(spark, [(7, "a b c d e f g")] * 3 + [(8, "q r s t u v")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(7, 7)] * 3 + [(8, 8)]


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:2500])
    one, other, union = setsketch.registers([a, b, np.unique(pool[:2500])], 400)
    assert (setsketch.merged(one, other) == union).all()
    estimate, _ = setsketch.estimates(one[None], other[None], np.array([len(a)]), np.array([len(b)]))
    assert estimate[0] == pytest.approx(1500 / 2500, abs=0.08)


def test_linked_pairs_are_exact():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 50).astype(np.uint64)) for _ in range(30)]
    found = setsketch.linked_pairs(sets, 60, 100)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert found[i, j] == (100 * both >= 60 * (len(a) + len(b) - both))


def test_components(spark):
    chain = [(i, i + 1) for i in range(10, 40)] + [(100, 101), (7, 7), (101, 99), (None, 3)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 10 for i in range(10, 41)}, 99: 99, 100: 99, 101: 99}
    assert common.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_blocks_bring_every_pair_together(spark):
    rows = [("g", i, 40) for i in range(40)] + [("h", 1, 1)]
    cut = common.blocks(spark.createDataFrame(rows, "key string, member bigint, size bigint"), "key", "member", "size", 4, 8).collect()
    met = set()
    for i in {(r["__i"], r["__j"]) for r in cut if r.key == "g"}:
        here = [r.member for r in cut if r.key == "g" and (r["__i"], r["__j"]) == i]
        met |= {(a, b) for a in here for b in here}
    assert len(met) == 40 * 40


def test_stars_connect_the_same_nodes_with_fewer_edges(spark):
    many = [(100 + i, c) for i in range(40) for c in range(1 + i % 3, 9)] + [(1, 2), (50, 50), (60, 61), (None, 3), (3, None)]
    edges = spark.createDataFrame(many, "a bigint, b bigint")
    left = common.stars(edges)
    assert left.count() == 40 + 7 + 6 + 5 + 1  # of 282: to 1, 2 or 3 from each high node and from the low ones above
    want = {n: 1 for n in [*range(1, 9), *range(100, 140)]} | {60: 60, 61: 60}
    assert {r.node: r.component for r in common.components(edges).collect()} == want
    assert {r.node: r.component for r in common.connected(left).collect()} == want
