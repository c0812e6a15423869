import pytest

from ratelattice.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).take(1)
