"""Trees, keys, axes and search on hand-written and random trees."""

import json
import random

import pytest

from ratelattice.operators import hierarchy
from tests.tiny import TinyTables, categories, entry, line, nodes, rows


def test_empty_group_has_one_placeholder(spark):
    t = TinyTables(spark, business_category=categories(1), group_node=nodes((3, 1, "G", 1), parent="business_category_id"))
    df = hierarchy.row_tree_keys(t).orderBy("key")
    assert rows(df, "key", "kind", "level", "id", "name") == [(1, "node", 0, 3, "G"), (2, "placeholder", 1, 3, "Add a sub group")]


def test_inactive_parent_hides_active_children(spark):
    t = TinyTables(
        spark,
        business_category=categories(1),
        group_node=nodes((1, 1, "G", 1), parent="business_category_id"),
        node_l1=nodes((1, 1, "A", 1)),
        node_l2=nodes((1, 1, "off", 0)),
        node_l3=nodes((1, 1, "hidden", 1)),
    )
    assert sorted(rows(hierarchy.row_tree(t), "level", "id")) == [(0, 1), (1, 1)]


def random_tree(rng):
    groups = [(i, rng.randint(1, 2), f"g{i}", int(rng.random() > 0.2)) for i in range(1, 6)]
    l1 = [(i, rng.randint(1, 5), f"a{i}", int(rng.random() > 0.2)) for i in range(1, 15)]
    l2 = [(i, rng.randint(1, 14), f"b{i}", int(rng.random() > 0.2)) for i in range(1, 30)]
    l3 = [(i, rng.randint(1, 29), f"d{i}", int(rng.random() > 0.2)) for i in range(1, 60)]
    return groups, l1, l2, l3


def walk(levels, category):
    """Display rows of one category by plain recursion."""
    out = []

    def visit(level, parent):
        for id_, up, name, active in sorted(levels[level]):
            if up == parent and active:
                out.append(("node", level, id_))
                if level < 3:
                    visit(level + 1, id_)
                    out.append(("placeholder", level + 1, id_))

    visit(0, category)
    return [(category, key, *row) for key, row in enumerate(out, 1)]


def test_keys_equal_a_walk(spark):
    levels = random_tree(random.Random(5))
    t = TinyTables(
        spark, business_category=categories(1, 2), group_node=nodes(*levels[0], parent="business_category_id"),
        node_l1=nodes(*levels[1]), node_l2=nodes(*levels[2]), node_l3=nodes(*levels[3]),
    )
    got = sorted(rows(hierarchy.row_tree_keys(t), "category_id", "key", "kind", "level", "id"))
    assert got == walk(levels, 1) + walk(levels, 2)
    axis = sorted(rows(hierarchy.row_axis(t), "position", "level", "id"))
    flat = [(level, id_) for c in (1, 2) for _, _, kind, level, id_ in walk(levels, c) if kind == "node"]
    assert axis == [(n, *row) for n, row in enumerate(flat, 5)]


def columns(spark):
    return TinyTables(
        spark,
        business_category=categories(1, 2, 3),
        business_sub_category=[
            {"id": 1, "business_category_id": 1, "name": "S1", "is_active": 1},
            {"id": 2, "business_category_id": 1, "name": "S2", "is_active": 1},
            {"id": 3, "business_category_id": 2, "name": "S3", "is_active": 0},
            {"id": 4, "business_category_id": 3, "name": "S4", "is_active": 1},
        ],
        product_line=[line(5, sub=1), line(6, sub=1, active=0), line(7, sub=1), line(8, sub=3), line(9, sub=4)],
    )


def test_column_tree(spark):
    df = hierarchy.column_tree(columns(spark)).orderBy("category_id", "sub_category_id", "position")
    assert rows(df, "category_id", "sub_category_id", "position", "title", "data_index") == [
        (1, 1, 1, "PL", "baserate"), (1, 1, 2, "Icon", ""), (1, 1, 3, "PL5", "PL5"), (1, 1, 4, "PL7", "PL7"),
        (1, 2, 1, "Icon", ""),
        (2, None, None, None, None),
        (3, 4, 1, "PL", "baserate"), (3, 4, 2, "Icon", ""), (3, 4, 3, "PL9", "PL9"),
    ]


def test_header_spans(spark):
    df = hierarchy.header_spans(columns(spark)).orderBy("level", "id")
    assert rows(df, "level", "id", "first_col", "last_col") == [
        ("category", 1, 1, 2), ("category", 2, 3, 2), ("category", 3, 3, 3),
        ("sub_category", 1, 1, 2), ("sub_category", 2, 3, 2), ("sub_category", 4, 3, 3),
    ]
    axis = hierarchy.column_axis(columns(spark)).orderBy("position")
    assert rows(axis, "position", "id") == [(1, 5), (2, 7), (3, 9)]


def searched(spark):
    return TinyTables(
        spark,
        business_category=categories(1),
        group_node=nodes((1, 1, "Alpha", 1), (2, 1, "Beta", 1), parent="business_category_id"),
        node_l1=nodes((1, 2, "red 5%", 1), (2, 2, "blue", 1), (3, 1, "green", 1), (4, 1, "Red 5x", 1)),
    )


def test_search(spark):
    t = searched(spark)
    found = lambda text: sorted(rows(hierarchy.tree_search(t, [text]), "level", "id", "name"), key=repr)
    assert found("ALPH") == [(0, 1, "Alpha")]
    assert found("blue") == [(1, 2, "blue")]
    # both groups have a match, the first one shows; no wildcards
    assert found("red 5") == [(1, 4, "Red 5x")]
    assert found("5%") == [(1, 1, "red 5%")]
    assert found("sub group") == [(1, None, "Add a sub group")]
    assert found("zzz") == []


def test_documents_are_segmented(spark):
    t = TinyTables(
        spark,
        business_category=categories(1),
        group_node=nodes((1, 1, "G", 1), parent="business_category_id"),
        node_l1=nodes((1, 1, "A", 1)),
        node_l2=nodes((1, 1, "B", 1)),
        product_line=[line(1, code='P"1'), line(1025)],
        rate_entry=[entry(1, 1, "0.1", l2=1), entry(2, 1025, "0.2", l2=1)],
    )
    docs = {(r["key"], r["segment"]): json.loads(r["doc"]) for r in hierarchy.group_tree_json(t).collect()}
    assert sorted(docs) == [(1, 0), (2, 0), (3, 0), (3, 1), (4, 0), (5, 0), (6, 0)]
    assert docs[3, 0]["cells"] == {"P1": {"quarter": 2, "value": [0.1], "businessSubCategoryId": 1, "rateEntryId": 1, "productLineId": 1}}
    assert list(docs[3, 1]["cells"]) == ["PL1025"]
    assert docs[4, 0] == {"key": 4, "level": 3, "parentId": 1, "baserate": "Add a sub group"}


def test_repeated_codes_are_settled_before_segments(spark):
    t = TinyTables(
        spark,
        business_category=categories(1),
        business_sub_category=[{"id": i, "business_category_id": 1, "name": f"S{i}", "is_active": 1} for i in (1, 2)],
        product_line=[line(1, "X", sub=1, base="1"), line(2000, 'X"', sub=2, base="2"), line(3, "Y")],
        group_node=nodes((1, 1, "G", 1), parent="business_category_id"),
        node_l1=nodes((1, 1, "A", 1)),
        node_l2=nodes((1, 1, "B", 1)),
        rate_entry=[entry(9, 1, "0.9", l2=1), entry(5, 2000, "0.5", l2=1)],
    )
    docs = [json.loads(r["doc"]) for r in hierarchy.group_tree_json(t).collect()]
    assert [c["rateEntryId"] for d in docs for c in d.get("cells", {}).values()] == [9]
    base = hierarchy.header_rows(t).filter("quarter = ''")
    assert sorted(rows(base, "code", "product_line_id", "business_sub_category_id")) == [("X", 2000, 2), ("Y", 3, 1)]
    heads = [json.loads(r["doc"]) for r in hierarchy.header_rows_json(t).filter("row_title LIKE 'BASE%'").collect()]
    assert sorted(code for d in heads for code in d["cells"]) == ["X", "Y"]


def test_pivot_bands_hold_every_code(spark):
    t = TinyTables(
        spark,
        business_category=categories(1),
        product_line=[line(i, f"P{i:02d}") for i in range(20)],
        group_node=nodes((1, 1, "G", 1), parent="business_category_id"),
        node_l1=nodes((1, 1, "A", 1)),
        node_l2=nodes((1, 1, "B", 1)),
        rate_entry=[entry(i + 1, i, f"0.{i + 10}", l2=1) for i in range(20)],
    )
    got = sorted(hierarchy.row_tree_pivot(t, 8).collect(), key=lambda r: r["band"])
    assert [float(r[f"r{i}"]) for r in got for i in range(8) if r[f"r{i}"] is not None] == [(i + 10) / 100 for i in range(20)]


@pytest.mark.parametrize("most", [3, 1024])
def test_nested_documents_hold_the_tree_in_key_order(spark, tables, most):
    docs = {}
    for r in hierarchy.category_tree_json(tables, most).collect():
        docs.setdefault((r["category_id"], r["level"], r["id"]), {})[r["segment"]] = json.loads(r["children"])

    def walk(category, children, found):
        for child in children:
            closing = "parentId" in child
            found.append((category, len(found) + 1, "placeholder" if closing else "node", child["level"], child["parentId" if closing else "id"], child["name"]))
            walk(category, child.get("children", []), found)
            parts = docs.get((category, child["level"], child["id"]), {}) if "segments" in child else {}
            assert len(parts) == child.get("segments", 0)
            for i in sorted(parts):
                walk(category, parts[i], found)
        return found

    got = []
    for category, level, node in docs:
        if level == -1:
            assert node == category
            parts = docs[category, -1, category]
            got += walk(category, [c for i in sorted(parts) for c in parts[i]], [])
    assert sorted(got) == sorted(rows(hierarchy.row_tree_keys(tables), "category_id", "key", "kind", "level", "id", "name"))

    def count(child):
        return 1 + sum(map(count, child.get("children", [])))

    assert max(sum(map(count, part)) for parts in docs.values() for part in parts.values()) <= 2 * most + 1


def test_search_for_a_table_of_texts(spark, tables):
    """Ten thousand texts, of every length and with odd ones among them, against a plain search."""
    tree = hierarchy.row_tree(tables, 2).collect()
    pieces = sorted({r["name"][i : i + n].swapcase() for r in tree for n in (1, 2, 3, 5) for i in range(0, len(r["name"]), 7)})[:200]
    texts = [*pieces, "", "a%", "_", "sub group", "group"] + [f"none {i}" for i in range(10_000 - len(pieces) - 5)]
    found = hierarchy.tree_search_table(tables, spark.createDataFrame([(t,) for t in [*texts, None, "group"]], "query string"))
    assert "Cartesian" not in found._jdf.queryExecution().executedPlan().toString() and "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    expected = set()
    groups = [r for r in tree if r["level"] == 0]
    below = [(r["category_id"], r["parent_id"], r["id"], r["name"]) for r in tree if r["level"] == 1] + [(g["category_id"], g["id"], None, "Add a sub group") for g in groups]
    for text in texts[: len(pieces) + 5]:
        roots = [(text, g["category_id"], 0, g["id"], g["name"]) for g in groups if text.lower() in g["name"].lower()]
        expected |= set(roots)
        for category in {g["category_id"] for g in groups} - {r[1] for r in roots}:
            hits = [b for b in below if b[0] == category and text.lower() in b[3].lower()]
            expected |= {(text, category, 1, b[2], b[3]) for b in hits if b[1] == min(h[1] for h in hits)}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
