import hashlib

import pytest
from pyspark.sql import functions as F

from ratelattice.llm import fingerprints as fp

from .tinydocs import ODD, documents, sentence


def shingles(text):
    words = [w for w in text.lower().replace("\t", " ").replace("\n", " ").split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def near(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("partitions", [1, 4])
def test_matches_brute_force(spark, partitions):
    rows = ODD + [(i, sentence(i % 17, 20 + i % 60)) for i in range(60)]
    rows = [r for r in rows if r[0] != 106]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = fp.edited_fingerprints(documents(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = []
    for at, (doc_id, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        a, b, c = shingles(text), shingles(edited), shingles(following)
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), near(a, b), near(a, c), float(len(a))))
    found = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next, r.shingles) for r in got]
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    for a, b in zip(sorted(found, key=key), sorted(expected, key=key), strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:])


def test_equal_texts_and_long_texts(spark):
    long_text = sentence(1, 5000)
    got = fp.edited_fingerprints(documents(spark, [(1, long_text), (2, long_text), (3, sentence(2, 4000))])).collect()
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[1] == prints[2] != prints[3]
    one = next(r for r in got if r.doc_id == 1)
    assert one.near_next == 1.0
    truth = shingles(long_text)
    assert one.shingles == pytest.approx(len(truth), rel=0.25)
    # the edited text goes on with the same text: its beginning, again
    assert one.near_edited == pytest.approx(near(truth, shingles(long_text[: len(long_text) - len(long_text) // 4] + long_text[: len(long_text) // 4])), abs=0.12)


def test_empty_table_and_merging(spark):
    assert fp.edited_fingerprints(documents(spark, [])).collect() == []
    texts = [sentence(3, 900), sentence(4, 700), sentence(3, 900)]
    df = fp.with_sketch(spark.createDataFrame([("k", t) for t in texts], "key string, text string"), "text", "sketch", k=64)
    whole = set().union(*[fp_hashes(spark, t) for t in texts])
    merged = fp.merge_groups(df.select("key", "sketch"), ["key"], "sketch", k=64).first()["sketch"]
    assert merged == sorted(whole)[:64]
    pair = df.limit(1).select("sketch").crossJoin(df.select(F.col("sketch").alias("other")).limit(2)).select(fp.containment(F.col("sketch"), F.col("other"), 64).alias("c")).collect()
    assert all(0 <= r.c <= 1 for r in pair)


def fp_hashes(spark, text):
    return set(fp.with_sketch(spark.createDataFrame([(text,)], "text string"), "text", "s", k=10**6).first()["s"])


def test_no_python_in_the_plan(spark):
    plan = fp.edited_fingerprints(documents(spark, [(1, "a b c")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan
