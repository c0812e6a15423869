"""Physical plans: what must not and what must be in them."""

import pytest

from ratelattice.plans.queries import PLANS

# these judge rate requests, or report on them
FOLDED = {"add_rate_entries", "update_rate_entries", "change_log_append", "audit_rows", "rate_asof_after_updates", "rate_rejections"}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_nested_loops_and_no_python(tables, name):
    text = physical(PLANS[name](tables))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    python = any(word in text for word in ("MapInArrow", "MapInPandas", "ArrowEvalPython", "BatchEvalPython"))
    assert not python or name in FOLDED


def test_asof_pushes_its_filter_and_prunes(spark, tables, tmp_path):
    from ratelattice.operators.history import rate_asof
    from ratelattice.schemas import TABLES

    tables.rate_change_log.limit(10).write.parquet(str(tmp_path / "log"))
    log = spark.read.schema(TABLES["rate_change_log"]).parquet(str(tmp_path / "log"))
    text = physical(rate_asof(log))
    assert "LessThanOrEqual(created_on" in text
    scan = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "note" not in scan and "old_rate" not in scan
    assert text.count("Exchange hashpartitioning") == 1
