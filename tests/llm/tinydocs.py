"""Small tables of documents with the odd cases in them."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, size string, component_id string, row string, score string"


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source); extra columns have names that operators use too."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or ""), "x", "y", "z", "r", "s") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def sentence(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice("ba be bi bo bu da de di do du ga ge gi go gu ka ke ki ko ku".split()) + rng.choice("lmnrst") for _ in range(n))


def changed(text: str, seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
    return " ".join(words)


ODD = [(100, None), (101, ""), (102, " \t\n"), (103, "one"), (104, "one two"), (104, "one two"), (105, "Ünïcode ✓ 漢字 \U0001f600 text"), (None, "nameless row here"), (106, "w " * 30_000)]
