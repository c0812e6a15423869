from collections import defaultdict

import pytest

from ratelattice.llm import pivotal

from .tinydocs import ODD, documents, sentence


def targets(sizes):
    """Filling by weight, source after source full."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    left, out, open_ = float(sum(sizes.values())), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * sizes[s] < level * weight[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        out |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(3 * sizes[s] for s in full)
        open_ -= full
    return out


def test_targets_and_words_taken(spark):
    names = ["a", "b", "Z", "é", "", None, "\U0001f600", "￮"]
    rows = [(i, sentence(i, 1 + i % 90), "a" if i % 3 == 0 else names[i % 8]) for i in range(900)] + [(5000 + i, t, "odd") for i, (_, t) in enumerate(ODD)]
    rows += [(7, sentence(7, 8), None)] * 2
    got = pivotal.mix(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes, longest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        longest[r.source] = max(longest[r.source], r.size)
        taken[r.source] += r.taken
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    wanted = targets(sizes)
    for r in got:
        assert r.target == pytest.approx(wanted[r.source]) and r.source_size == sizes[r.source]
    for source in sizes:
        assert abs(taken[source] - wanted[source]) <= longest[source]
    again = pivotal.mix(documents(spark, rows[::-1])).collect()
    assert sorted((str(r.doc_id), r.size, r.copies) for r in got) == sorted((str(r.doc_id), r.size, r.copies) for r in again)


def test_many_levels_keep_the_words(spark, monkeypatch):
    monkeypatch.setattr(pivotal, "FAN_IN", 4)
    rows = [(i, "w " * (1 + i % 13), f"s{i % 2}") for i in range(400)]
    got = pivotal.mix(documents(spark, rows)).collect()
    for source in ("s0", "s1"):
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 13


def test_rounding_is_fair():
    total = [0, 0]
    for i in range(4000):
        out, _ = pivotal.round_group([0.3, 0.4], [10, 20], [0.0, pivotal._draw(1, 0, i)])
        assert 10 * out[0] + 20 * out[1] == pytest.approx(11)
        total = [a + b for a, b in zip(total, out, strict=True)]
    assert total[0] / 4000 == pytest.approx(0.3, abs=0.04)


def test_empty_tables(spark):
    assert pivotal.mix(documents(spark, [])).collect() == []
    got = pivotal.mix(documents(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
