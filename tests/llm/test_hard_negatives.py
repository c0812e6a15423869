import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelattice.llm import kronecker

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "r") for r in rows], SCHEMA)


def mined(spark, rows, every=5):
    usable = kronecker.usable(frame(spark, rows))
    return sorted(map(tuple, kronecker.hard_negatives(usable, F.col("vec_id") % every == 0).collect()))


def brute(rows, every=5):
    clean = []
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        clean.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    out = []
    for a, va, la in clean:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(va, vb)), b, lb) for b, vb, lb in clean if b != a]
        for s, b, _ in sorted(x for x in scored if x[2] == la)[:5]:
            fits = sorted(x for x in scored if x[2] != la and 30 * -s <= 100 * -x[0] <= 90 * -s)[:10]
            out += [(a, b, i + 1, n, -s, -t) for i, (t, n, _) in enumerate(fits)]
    return sorted(out)


def vectors(seed, n, dims, scale=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0.1, 0.3) * scale for _ in range(dims)], rng.choice([0, 0, 0, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("block", [kronecker.BLOCK_ANCHORS, 7])
def test_matches_brute_force(spark, monkeypatch, block):
    """A hot label, ties from equal vectors, odd rows, several blocks of anchors."""
    monkeypatch.setattr(kronecker, "BLOCK_ANCHORS", block)
    monkeypatch.setattr(kronecker, "CELLS", 500)
    rows = vectors(1, 150, 8) + [(200 + i, [0.5] * 8, i % 2) for i in range(30)]
    rows += [(300, None, 1), (305, [float("nan")] * 8, 1), (310, [float("inf")] + [0.0] * 7, 1), (315, [None] * 8, 1), (320, [0.1] * 8, None), (None, [0.9] * 8, 1), (325, [], 1), (330, [1.0, 1.0], 2)]
    assert mined(spark, rows) == brute(rows)


def test_wide_numbers(spark):
    """Numbers for which no two fields fit into a double."""
    rows = vectors(2, 60, 6, scale=3e6)
    assert mined(spark, rows) == brute(rows)


@pytest.mark.parametrize("scale", [1, 40, 1 << 12, 1 << 20, 1 << 30])
def test_fields_unpack_to_exact_products(scale):
    rng = np.random.default_rng(scale)
    a, c = (rng.integers(-scale, scale + 1, (n, 5)) for n in (9, 23))
    assert kronecker.products(a, c).tolist() == [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in c] for u in a]
    assert kronecker.products(a[:0], c).shape == (0, 23)


def test_empty_tables(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 0)]) == [] and mined(spark, [(5, [1.0], 0)]) == []
