import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from ratelattice.llm import queries

from .test_near_duplicates import brute as near_brute
from .tinydocs import ODD, changed, documents, sentence

SF = "/root/testdata/sf0.001"



def keys(rows):
    return Counter((r.doc_id, r.text) for r in rows)


@pytest.fixture(scope="module")
def docs(spark):
    base = sentence(5, 80)
    rows = [(i, sentence(i, 12 + i % 40), f"src{i % 3}") for i in range(60)]
    rows += [(100 + i, changed(base, i, i % 6), None) for i in range(15)] + [(200 + i, f"{base} ", "src1") for i in range(4)]
    rows += [(r[0] and 1000 + r[0], *r[1:]) for r in ODD if r[0] != 106] + [(3, sentence(3, 15), "src0")] * 2
    return documents(spark, rows)


def test_stages_keep_columns_and_accept_an_empty_table(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert stage(spark, docs.limit(0), SF).collect() == []


def test_exact_copies(spark, docs):
    got = corpus_pipeline.drop_exact_copies(spark, docs, SF).collect()
    groups = defaultdict(list)
    for r in docs.collect():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
    assert Counter((r.doc_id, re.sub(r"[\x20\x09-\x0D]", "", r.text or "")) for r in got) == Counter({(None if min(v)[1] else min(v)[2], k): 1 for k, v in groups.items()})


def test_near_copies(spark, docs):
    got = corpus_pipeline.drop_near_copies(spark, docs, SF).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = {d for d, _, low in near_brute(rows, 5, 80, 100) if d == low}
    assert Counter(r.doc_id for r in got if r.doc_id is not None) == dict.fromkeys(expected, 1)
    assert sum(r.doc_id is None for r in got) == 1


def test_mixing_takes_rows_as_often_as_the_operator_says(spark, docs):
    got = keys(corpus_pipeline.mix_sources(spark, docs, SF).collect())
    from ratelattice.llm import pivotal

    copies = Counter()
    for r in pivotal.mix(docs).collect():
        copies[r.doc_id, r.size] += r.copies
    found = Counter()
    for (doc_id, text), n in got.items():
        found[doc_id, len((text or "").encode().split())] += n
    assert found == {k: n for k, n in copies.items() if n}


def test_toxic_documents_go(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, table, SF).collect()}
    scored = {r.doc_id: r.predicted for r in queries.op4_toxicity(spark, SF).collect()}
    assert kept == {d for d, p in scored.items() if not p}


def test_run(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    held = defaultdict(int)
    for r in got:
        held[r.sequence_id] += r.length
    assert held and all(n == 1024 or n & (n - 1) == 0 for n in held.values())
