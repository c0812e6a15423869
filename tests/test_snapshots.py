import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from ratelattice.operators import history, snapshots
from ratelattice.schemas import TABLES

MOMENTS = [
    "2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-03-31 23:59:59.999999", "2024-04-01 00:00:00",
    "2024-04-01 00:00:01", "2024-05-20 12:00:00", "2024-12-31 00:00:00", "2030-01-01 00:00:00",
]


def changes(spark, first, n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = datetime(2024, 1, 1) + timedelta(seconds=rng.choice([0, 1, 86400 * 91, rng.randrange(86400 * 300)]))
        entry = 1 if rng.random() < 0.4 else rng.randrange(2, 40)
        rows.append((first + i, None, "u", None if rng.random() < 0.05 else at, Decimal(rng.randrange(1000)), None, None if rng.random() < 0.02 else entry, None))
    return spark.createDataFrame(rows, TABLES["rate_change_log"])


def same(spark, folder, log):
    for m in MOMENTS:
        got = sorted(map(tuple, snapshots.rate_asof_stored(spark, folder, m).collect()), key=str)
        assert got == sorted(map(tuple, history.rate_asof(log, m).collect()), key=str), m


def test_snapshots_give_the_rates_of_the_whole_log(spark, tmp_path):
    folder, log = str(tmp_path / "store"), changes(spark, 1, 400, 0)
    snapshots.create_store(log, folder)
    same(spark, folder, log)
    snapshots.take_snapshots(spark, folder, [date(2024, 6, 1), date(2024, 1, 1), date(2024, 4, 1)])
    assert snapshots.snapshots(spark, folder) == {date(2024, 1, 1): 1, date(2024, 4, 1): 1, date(2024, 6, 1): 1}
    same(spark, folder, log)
    late = changes(spark, 1000, 60, 1)
    snapshots.append_changes(late, folder)
    assert snapshots.snapshots(spark, folder) == {date(2024, 1, 1): 1, date(2024, 4, 1): 2, date(2024, 6, 1): 2}
    same(spark, folder, log.unionByName(late))
    # a version that was not written to its end does not count
    (tmp_path / "store/snapshots/at=2024-06-01/version=3").mkdir()
    same(spark, folder, log.unionByName(late))


def test_empty_log_and_wrong_day(spark, tmp_path):
    folder, log = str(tmp_path / "store"), changes(spark, 1, 0, 0)
    snapshots.create_store(log, folder, [date(2024, 2, 1)])
    assert snapshots.rate_asof_stored(spark, folder, MOMENTS[3]).collect() == []
    with pytest.raises(ValueError):
        snapshots.take_snapshots(spark, folder, [date(2024, 2, 2)])


def test_a_moment_reads_one_snapshot_and_the_months_after_it(spark, tmp_path):
    folder = str(tmp_path / "store")
    snapshots.create_store(changes(spark, 1, 300, 2), folder, [date(2024, 2, 1), date(2024, 5, 1)])
    files = snapshots.rate_asof_stored(spark, folder, "2024-06-15 00:00:00").inputFiles()
    plan = snapshots.rate_asof_stored(spark, folder, "2024-06-15 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "at=2024-05-01" in "".join(files) and "at=2024-02-01" not in "".join(files)
    filters = [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]]
    assert any("2024-05-01" in f and "2024-06-01" in f for f in filters) and plan.count("Exchange") == 1
