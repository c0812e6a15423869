"""Every registered query against its DuckDB twin on the smallest data set."""

import pytest

import __spark_entry__ as contract
from ratelattice.operators import settling
from ratelattice.plans.queries import PLANS
from tests.compare import connect, difference
from tests.conftest import SF

QUERIES, TWINS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_rate_query_has_a_twin():
    assert set(PLANS) <= set(QUERIES) and set(PLANS) <= set(TWINS)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck, TWINS[name]) is None


CHUNKED = [
    "rate_changes", "rate_intervals", "rate_intervals_events", "entry_history", "row_tree_keys", "matrix_axes", "column_tree",
    "header_spans", "upsert_product_lines", "upsert_nodes", "add_rate_entries", "update_rate_entries",
]


@pytest.mark.parametrize("name", CHUNKED)
def test_query_with_split_groups(spark, duck, chunking, monkeypatch, name):
    monkeypatch.setattr(settling, "ROUNDS", 2)  # split windows take long on small tables
    assert difference(QUERIES[name](spark, SF), duck, TWINS[name]) is None


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["row_no", "col_no", "level", "node_id", "product_line_id", "rate"]
    assert df.count() == 2068
