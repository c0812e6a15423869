import math
import re
from collections import Counter

import numpy as np
import pytest

from ratelattice.llm import reversedsearch

from .tinydocs import ODD, documents, sentence

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    held = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for (doc, counts), n in zip(held, sizes):
            score = 0
            for t in set(terms(text)) & set(counts):
                m = 100 - 90 + 90 * n * n_docs // length
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * counts[t] // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def frame(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, rank string")


ITEMS = [(1, sentence(1, 12)), (2, "Ünïcode ✓ 漢字 text"), (3, None), (4, ""), (5, " -- !"), (6, "nothing-like-it"), (None, sentence(2, 5)), (7, sentence(1, 12)), (7, "One two, ONE"), (8, "w")]


@pytest.mark.parametrize("postings", [reversedsearch.POSTINGS, 60])
def test_matches_brute_force(spark, monkeypatch, postings):
    """Also with several blocks of items, hot equal texts, rows without a doc_id and a very long text."""
    monkeypatch.setattr(reversedsearch, "POSTINGS", postings)
    docs = ODD + [(i, sentence(i % 9, 5 + i % 23)) for i in range(60)] + [(200 + i, sentence(1, 12)) for i in range(30)] + [(300, sentence(5, 20_000))]
    got = reversedsearch.reversed_search(documents(spark, docs), frame(spark, ITEMS)).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, ITEMS)


def test_empty_tables(spark):
    one = documents(spark, [(1, "a b")])
    assert reversedsearch.reversed_search(documents(spark, []), frame(spark, ITEMS)).collect() == []
    assert reversedsearch.reversed_search(one, frame(spark, [])).collect() == []
    assert reversedsearch.reversed_search(one, frame(spark, [(1, None)])).columns == ["item_id", "rank", "doc_id", "score"]


def test_long_sums_are_exact():
    """Beyond 53 bits the sums are taken in whole numbers."""
    index = reversedsearch.Index([[b"a", b"b"]])
    index.weights[:] = (1 << 34) - 1
    value = np.array([999_999, 999_998])
    scores = index.scores(1, np.array([0, 0]), np.array([0, 1]), value)
    assert scores.tolist() == [[((1 << 34) - 1) * int(value.sum())]]
    assert reversedsearch.lengths(np.array([1 << 40]), 1 << 30, 1 << 50).tolist() == [10 + 90 * (1 << 70) // (1 << 50)]
