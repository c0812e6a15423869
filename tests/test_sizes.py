"""What is numbered, written and read again where batches are large."""

from pyspark.sql import functions as F

from ratelattice import skew
from ratelattice.operators import admission, lookups, mutations
from ratelattice.plans.requests import node_requests, update_rate_requests


def test_only_inserted_nodes_are_numbered(tables, monkeypatch):
    numbered, total = [], mutations.running_total
    monkeypatch.setattr(mutations, "running_total", lambda df, *args, **more: numbered.append(df.count()) or total(df, *args, **more))
    done = mutations.upsert_nodes(lookups.all_nodes(tables), node_requests(tables))
    assert numbered == [done.filter(F.col("outcome") == mutations.INSERT).count()]
    assert done.count() == node_requests(tables).count()


def test_requests_of_ordinary_families_are_not_copied_by_windows(tables, chunking, spark, monkeypatch):
    spark.conf.set(skew.MAX_GROUP_ROWS, "1000000")
    kept, keep = [], skew.keep
    monkeypatch.setattr(skew, "keep", lambda df, name: kept.append((name, df.count())) or keep(df, name))
    requests = update_rate_requests(tables)
    done = admission.update_rate_entries(tables, requests)
    assert done.count() == requests.count()
    assert not any(rows for _, rows in kept)
