import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratelattice.llm import queries, toxicity

from .tinydocs import ODD, documents, sentence

MEAN = ["blasted", "rotten", "vileness", "filthy"]


def corpus(n=240):
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = sentence(i, 60)
        rows.append((i, f"{words} {MEAN[i % 3]} {MEAN[(i // 4) % 4]} {sentence(i + 999, 20)}" if toxic else words))
        labels.append((i, int(toxic), 5))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    rows += [(r[0] and 1000 + r[0], r[1]) for r in ODD]
    docs, table = documents(spark, rows), spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0), (9999, 1, 0), (5, 0, 1), (5, 0, 1)], "doc_id bigint, toxic int, text int")
    index = toxicity.fit(docs, table.filter(~toxicity.held_out(F.col("doc_id"))))
    got = toxicity.score_texts(docs, index).withColumn("held_out", toxicity.held_out(F.col("row.doc_id"))).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, t, _ in labels}
    out = [r for r in got if r.held_out and r.row.doc_id in truth]
    assert len(out) > 20 and all((r.score >= 0.5) == bool(truth[r.row.doc_id]) for r in out)
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.score < 0.2 and not r.evidence for r in got if r.row.doc_id in (1100, 1101, 1102))
    toxic = next(r for r in out if truth[r.row.doc_id])
    assert toxic.evidence and all(not queries_held_out(d) for d in toxic.evidence)


def queries_held_out(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_neighbours_are_exact():
    rng = np.random.default_rng(0)
    index = toxicity.Index([], {f"t{i}": i for i in range(40)}, k=7)
    vectors = []
    for _ in range(500):
        terms = rng.choice(40, rng.integers(1, 6), replace=False)
        values = rng.random(len(terms)) + 0.1
        vectors.append(dict(zip(map(int, terms), values / np.linalg.norm(values), strict=True)))
    index.build(vectors, [0] * 500, list(range(500)))
    dense = np.zeros((500, 40))
    for i, v in enumerate(vectors):
        dense[i, list(v)] = list(v.values())
    for query in vectors[:60]:
        q = np.zeros(40)
        q[list(query)] = list(query.values())
        _, values = index.nearest(query)
        assert sorted(values) == pytest.approx(sorted(dense @ q)[-7:])


def test_terms_and_vectors():
    assert toxicity.word_terms("vileness") == ["vileness", "vile*", "vilen*", "vilene*"]
    terms = ["vile*", "vileness", "vilen*", "st", "ünde*"]
    index = toxicity.Index([1.0] * 5, {t: i for i, t in enumerate(terms)})
    text = "Vileness; vile evileness 2vilenes, vilenesses st. Stst ünder_Ünde ündes1"
    words = [w for w in toxicity._WORDS.findall(text.lower())]
    expected = Counter(index.number[t] for w in words for t in toxicity.word_terms(w) if t in index.number)
    assert index.counts(text) == expected and len(expected) == 5
    assert index.vector("nothing") == {} and index.vector(None) == {}


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1)], [(77, 1)]])
def test_without_both_labels(spark, labels):
    docs = documents(spark, [(1, "some words"), (2, None)])
    index = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert all(0 <= r.score <= 1 for r in toxicity.score_texts(docs, index).collect())
    assert toxicity.score_texts(documents(spark, []), index).collect() == []


def test_registered_query(spark):
    got = queries.op4_toxicity(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and all(r.predicted == int(r.score >= 0.5) for r in got)


def test_every_row_meets_its_nearest_examples_over_the_full_vocabulary(spark):
    """Brute force: dense vectors over every word of the examples, all products, the k largest."""
    rows, labels = corpus(160)
    rows += [(5000, "日本語の文章です 日本語"), (5001, "這是一個句子"), (5002, f"{sentence(3, 4000)} rotten"), (5003, "unheard-of"), (5004, None)]
    labels += [(5000, 0, 1), (5001, 1, 1)]
    docs, table = documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, toxic int, text int")
    index = toxicity.fit(docs, table, k=5)
    texts, truth = dict(rows), {i: t for i, t, _ in labels}
    ids = index.names.tolist()
    assert sorted(ids) == sorted(truth)

    def bag(text):
        found = Counter()
        for word in toxicity._WORDS.findall((text or "").lower()):
            found.update(toxicity.word_terms(word))
        return found

    bags = {i: bag(t) for i, t in texts.items()}
    everything = {t for i in ids for t in bags[i]}
    plain = {t for t in everything if not t.endswith("*")}
    assert plain <= set(index.number) and all(t in everything for t in index.number)
    terms = sorted(index.number)
    n = len(ids)
    n_toxic = sum(truth.values())
    h = -sum(p * np.log(p) for p in (n_toxic / n, 1 - n_toxic / n))
    weight = []
    for t in terms:
        having = [truth[i] for i in ids if t in bags[i]]
        a, df, gain = sum(having), len(having), 0.0
        for some, label in ((a, n_toxic), (df - a, n - n_toxic)):
            for k, part in ((some, df), (label - some, n - df)):
                gain += k / n * np.log(k * n / (label * part)) if k else 0.0
        weight.append((np.log((1 + n) / (1 + df)) + 1) * (toxicity.FLOOR + max(gain, 0) / h))
    dense = {i: np.array([(1 + np.log(b[t])) * w if b[t] else 0.0 for t, w in zip(terms, weight, strict=True)]) for i, b in bags.items()}
    dense = {i: v / max(np.linalg.norm(v), 1e-300) for i, v in dense.items()}
    for i, text in texts.items():
        all_products = sorted((float(dense[i] @ dense[j]) for j in ids), reverse=True)
        found, values = index.nearest_to(*index.arrays(text))
        assert values.tolist() == pytest.approx([v for v in all_products[:5] if v > 0], rel=1e-5)
        for j, v in zip(found, values, strict=True):
            assert float(dense[i] @ dense[ids[j]]) == pytest.approx(v, rel=1e-5)
        assert len(found) or i in (5003, 5004)
    got = {r.row.doc_id: r for r in toxicity.score_texts(docs, index).collect()}
    assert got[5002].score > 0.5 and got[5003].score == got[5004].score == index.empty_share


def test_many_blocks_and_left_out_examples():
    rng = np.random.default_rng(1)
    index = toxicity.Index([], {f"t{i}": i for i in range(3000)}, k=9)
    vectors = []
    for i in range(2000):
        terms = np.unique(np.r_[rng.integers(0, 3000, 3), (i // 128) * 40 + rng.integers(0, 40, 4)])
        values = rng.random(len(terms)) + 0.1
        vectors.append(dict(zip(map(int, terms), values / np.linalg.norm(values), strict=True)))
    vectors[7] = vectors[1990]  # a tie
    index.build(vectors, [0] * 2000, list(range(2000)))
    dense = np.zeros((2000, 3000))
    for i, v in enumerate(vectors):
        dense[i, list(v)] = list(v.values())
    for q in [*range(0, 2000, 40), 7, 1990]:
        exact = np.round(dense @ dense[q], 6)
        exact[q] = -1
        found, values = index.nearest(vectors[q], without=q)
        assert q not in found and sorted(values) == pytest.approx(sorted(exact[exact > 0])[-9:], abs=1e-5)


def test_votes_that_part_the_labels_give_a_bounded_curve():
    index = toxicity.Index([], {})
    with np.errstate(all="raise"):
        index.fit_curve(np.array([0.0] * 50 + [1.0] * 50), np.array([0.0] * 50 + [1.0] * 50), np.ones(100))
    assert 0 < index.curve[0] <= toxicity.STEEPEST and abs(index.curve[1]) <= toxicity.STEEPEST


def test_frequent_terms_come_from_the_matrix_and_the_rest_from_the_blocks(monkeypatch):
    """Products of a batch equal brute force, and no query goes through the postings of frequent terms again."""
    rng = np.random.default_rng(2)
    index = toxicity.Index([], {f"t{i}": i for i in range(2000)}, k=6)
    vectors = []
    for i in range(1500):
        terms = np.unique(np.r_[rng.choice(20, 8, replace=False), rng.integers(20, 2000, 5)]) if i % 50 else np.zeros(0, np.int64)
        values = rng.random(len(terms)) + 0.1
        vectors.append(dict(zip(map(int, terms), (values / max(np.linalg.norm(values), 1e-9)).tolist(), strict=True)))
    vectors[31] = vectors[1400 + 1]  # a tie
    index.build(vectors, [0] * 1500, list(range(1500)))
    dense = np.zeros((1500, 2000), dtype=np.float32)
    for i, v in enumerate(vectors):
        dense[i, list(v)] = list(v.values())
    queries = [(np.array(sorted(v), dtype=np.int64), np.array([v[t] for t in sorted(v)])) for v in (*vectors[::30], vectors[31], {7: 1.0}, {1500: 1.0}, {})]
    begun = index.begun(queries)
    read = []
    spread = toxicity._spread
    monkeypatch.setattr(toxicity, "_spread", lambda starts, ends: read.append(int((ends - starts).sum())) or spread(starts, ends))
    for (terms, weights), row in zip(queries, begun, strict=True):
        exact = dense[:, terms].astype(np.float64) @ weights
        read.clear()
        found, values = index.nearest_to(terms, weights, begun=row)
        best = np.lexsort((np.arange(1500), -np.round(exact, 12)))[:6]
        assert found.tolist() == [i for i in best if exact[i] > 0] and values == pytest.approx(exact[found], abs=1e-12)
        assert sum(read) <= 2 * int((dense[:, terms[terms >= 20]] > 0).sum())
        alone = index.nearest_to(terms, weights)
        assert alone[0].tolist() == found.tolist() and alone[1] == pytest.approx(values, abs=1e-12)


def test_a_worker_unpacks_the_index_once(spark):
    from ratelattice.llm.common import Packed

    index = toxicity.Index([1.0, 2.0], {"one": 0, "two": 1})
    index.build([{0: 1.0}, {1: 1.0}], [0, 1], [1, 2])
    sent = spark.sparkContext.broadcast(Packed(index))

    def run(batches):
        yield from (pa.record_batch([pa.array([id(sent.value)] * b.num_rows), pa.array([sent.value.number["two"]] * b.num_rows), pa.array([os.getpid()] * b.num_rows)], names=["at", "two", "worker"]) for b in batches)

    rows = spark.range(0, 200, 1, 40).mapInArrow(run, "at bigint, two bigint, worker bigint").distinct().collect()
    assert {r.two for r in rows} == {1}
    assert len({(r.worker, r["at"]) for r in rows}) == len({r.worker for r in rows})  # tasks of a worker share it
