import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

from ratelattice.llm import quotientfilter

from .tinydocs import ODD, documents, sentence


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, text or ""))
    out = []
    for normal, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        sha = hashlib.sha256(normal.encode()).hexdigest()
        out += [(m[0], keep[0], len(members), sha) for m in members]
    return Counter(out)


ROWS = [(i, sentence(i % 7, 10)) for i in range(40)] + [(50 + i, sentence(3, 10).replace(" ", " " * (i + 1))) for i in range(5)] + [(None, sentence(3, 10)), (None, "only")] + ODD


def test_matches_brute_force(spark):
    got = quotientfilter.exact_duplicates(documents(spark, ROWS)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute(ROWS)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept) == {r.text_sha256 for r in got} and set(kept.values()) == {1}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(quotientfilter, "fingerprint", lambda normal: len(normal) % 2)
    got = quotientfilter.exact_duplicates(documents(spark, ROWS)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute(ROWS)


def test_empty_and_unique_tables(spark):
    assert quotientfilter.exact_duplicates(documents(spark, [])).collect() == []
    got = quotientfilter.exact_duplicates(documents(spark, [(1, "a"), (2, "b")])).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == [(1, 1, 1, True), (2, 2, 1, True)]


def test_filters_merge_without_loss(spark):
    rng = np.random.default_rng(0)
    values = [int(v) for v in rng.integers(-(2**63), 2**63 - 1, 300)] * 2 + [5] * 500 + [-1] * 3 + [int(v) for v in rng.integers(0, 2**40, 200)]
    got = quotientfilter.repeated_fingerprints(spark.createDataFrame([(v,) for v in values], "fp bigint").repartition(5), len(values)).collect()
    assert {r.fp: r.n for r in got} == {v: n for v, n in Counter(values).items() if n > 1}
