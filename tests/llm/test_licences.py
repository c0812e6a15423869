import pytest

from ratelattice.llm import licences

from .tinydocs import ODD, documents, sentence


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, f"{sentence(i, 30)}\n{sentence(i + 50, 20)}") for i in range(40)]
    rows += [
        (200, sentence(1, 20) + "\nThis library is licensed under the Apache License, Version 2.0.\n" + sentence(2, 20)),
        (201, "Released under the MIT License."),
        (202, "This work is licensed under the GNU General Public License, version 3."),
        (203, "Licensed under CC BY-NC 4.0."),
        (204, "The driver showed his licence to the public."),
        (205, sentence(9, 100) + " released under the Mozilla Public License 2.0 " + sentence(10, 100)),
        (205, "SPDX-License-Identifier: BSD-3-Clause"),
    ]
    return licences.scan(documents(spark, rows + [r for r in ODD if r[0] != 106])).collect()


def test_families(found):
    sure = {(r.doc_id, r.family) for r in found if r.confirmed}
    assert sure == {(200, "apache"), (201, "mit"), (202, "gpl"), (203, "cc-by-nc"), (205, "mpl"), (205, "bsd")}
    assert next(r for r in found if r.doc_id == 200).paragraph == 1


def test_unknown(found):
    assert not [r for r in found if r.confirmed and (r.doc_id is None or r.doc_id < 200 or r.doc_id == 204)]


def test_plan_has_no_python_and_paragraphs_are_whole(spark):
    docs = documents(spark, [(1, " ".join(f"w{i}" for i in range(200)) + "\n\nlast line"), (2, None)])
    rows = licences.paragraphs(docs.select("doc_id", "text"), "doc_id")
    got = rows.collect()
    assert {w for r in got for w in r.words} == {f"w{i}" for i in range(200)} | {"last", "line"}
    plan = licences.with_terms(rows)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert licences.paragraphs(documents(spark, []).select("doc_id", "text"), "doc_id").collect() == []
    assert licences.scan(documents(spark, [])).collect() == []


def test_wrapped_one_word_and_unlisted_licences(spark):
    rows = [(i, f"{sentence(i, 30)}\n{sentence(i + 50, 20)}") for i in range(40)]
    rows += [
        (300, "Intro words\n\n# Licensed under the Apache License,\n# Version 2.0"),
        (301, "Redistribution and use in source and binary forms,\nwith or without modification, are permitted\nprovided that the following conditions are met"),
        (302, "SPDX-License-Identifier: MIT"),
        (303, "Licensed under MIT"),
        (304, "License: ISC"),
        (305, "This work is licensed under the Zlib License."),
        (306, "The institute at MIT published the source."),
    ]
    got = licences.scan(documents(spark, rows)).collect()
    sure = {(r.doc_id, r.family) for r in got if r.confirmed}
    assert sure == {(300, "apache"), (301, "bsd"), (302, "mit"), (303, "mit"), (304, "isc")}
    assert [r.paragraph for r in got if r.doc_id == 300 and r.confirmed] == [2]
    assert {(r.family, r.confirmed) for r in got if r.doc_id == 305} == {("unknown", False)}


def test_texts_without_a_word_that_names_licences_are_cut_and_scored(spark, monkeypatch):
    rows = [(i, f"{sentence(i, 30)}\n{sentence(i + 50, 20)}") for i in range(40)]
    cut, sizes = licences.paragraphs, []
    monkeypatch.setattr(licences, "paragraphs", lambda docs, *columns: sizes.append(docs.count()) or cut(docs, *columns))
    licences.scan(documents(spark, rows))
    assert sizes[-1] == len(rows)


def test_windows_leave_one_generator_so_that_the_filter_makes_no_terms_anew(spark):
    words = [f"w{i}" for i in range(200)]
    docs = documents(spark, [(1, " ".join(words[:150]) + "\n" + " ".join(words[150:])), (2, "one\n\ntwo words\n"), (3, " ".join(words[:65]))])
    rows = licences.paragraphs(docs.select("doc_id", "text"), "doc_id")
    got = sorted(rows.collect(), key=lambda r: (r.doc_id, r.paragraph, r.window))
    assert [(r.doc_id, r.paragraph, r.window, len(r.words)) for r in got] == [(1, 0, 0, 64), (1, 0, 1, 64), (1, 0, 2, 64), (1, 0, 3, 56), (2, 0, 0, 1), (2, 2, 0, 2), (3, 0, 0, 64), (3, 0, 1, 17)]
    for r in got:
        assert r.pairs == [f"{a} {b}" for a, b in zip(r.words[:-1], r.words[1:], strict=True)]
    assert [r.at for r in got if r.doc_id == 1][3] == [0] * 6 + [1] * 50
    assert all(r.terms == q.words + q.pairs for r, q in zip(sorted(licences.with_terms(rows).collect(), key=lambda r: (r.doc_id, r.paragraph, r.window)), got, strict=True))
    plan = licences.scan(docs)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "UDF" in line]
    assert filters and not any("lambdafunction" in line for line in filters)
