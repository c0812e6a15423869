import re
from collections import Counter

import pytest

from ratelattice.llm import lineruns

from .tinydocs import ODD, documents, sentence

UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
BLANK = "[\\x20\\x09-\\x0D]+"


def key(line):
    return re.sub(f"^{BLANK}|{BLANK}$", "", line).translate(UPPER)


def brute(docs):
    owner = lambda d: float("inf") if d is None else d
    first = {}
    for d, text in docs:
        for line in (text or "").split("\n"):
            first[key(line)] = min(first.get(key(line), float("inf")), owner(d))
    out = []
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == owner(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


COMMON = "A Line That Very Many Documents Share"
DOCS = [(i, "\n".join([sentence(i % 7, 4), f"  {COMMON}\t" if i % 3 == 0 else "short", COMMON.upper(), sentence(100 + i, 3), "", sentence(i % 5, 6)])) for i in range(60)]
DOCS += ODD + [(None, COMMON), (None, "nameless row here\nnameless row here"), (500, "ÄÖÜ äöü grüße\nÄÖÜ äöü GRÜSSE"), (501, "äöü äöü grüße\nÄÖÜ äöü grüsse"), (502, "\n\n\n"), (503, COMMON), (503, f"{COMMON}\nother line of it")]
DOCS += [(504, "\n".join(sentence(i % 900, 5) for i in range(20_000)))]


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_matches_brute_force(spark, batches):
    """Runs of several levels give what one batch gives."""
    got = lineruns.drop_repeated_lines(documents(spark, DOCS), batches).collect()
    assert Counter(map(tuple, got)) == brute(DOCS)


def test_hot_keys_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lineruns, "HOT_LINES", 5)
    got = lineruns.drop_repeated_lines(documents(spark, DOCS), 3).collect()
    assert Counter(map(tuple, got)) == brute(DOCS)


def test_runs_are_merged_by_level_and_joined_without_shuffle(spark):
    runs = lineruns.LineRuns(spark)
    rows = lineruns.lines(lineruns._documents(documents(spark, DOCS)))
    for i in range(6):
        batch = rows.filter(f"pmod(h1, 6) = {i} or h2 % 3 = 0")
        judged = runs.add(batch)
        assert judged.filter("seen").count() == (0 if i == 0 else judged.filter("h2 % 3 = 0").count())
    assert [len(level) for level in runs.levels] == [2, 0, 1]
    run, other = runs.levels[0]
    plan = run.join(other.hint("merge"), lineruns.HASH)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    names = list(runs.names)
    runs.close()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_empty_table(spark):
    assert lineruns.drop_repeated_lines(documents(spark, [])).collect() == []
