"""Split windows against plain ones, with one group holding a third of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ratelattice import skew


@pytest.fixture
def events(spark):
    # a third of the rows in group 0, many equal timestamps, a few null groups
    df = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 97 == 1, F.lit(None)).otherwise(F.col("id") % 50).alias("g"),
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(cast(id * 7919 % 40 as int))").alias("ts"),
        (F.col("id") * 31 % 17).alias("v"),
    )
    return df


def table(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_hot_group_is_found_and_sliced(events, spark, chunking):
    spark.conf.set(skew.MAX_GROUP_ROWS, "500")
    hot = skew.hot_groups(events, ["g"])
    assert [r["g"] for r in hot.collect()] == [0]
    sizes = skew.slices(events.filter("g = 0"), ["g", "ts", "id"]).groupBy("__slice").count().collect()
    assert len(sizes) == 12
    assert max(r["count"] for r in sizes) < 200


def test_small_input_is_left_alone(events):
    assert skew.is_small(events)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("keys", [["g"], []])
def test_running_total(events, chunking, keys, descending):
    order = [F.col(c).desc() if descending else F.col(c) for c in ("ts", "id")]
    w = Window.partitionBy(*keys).orderBy(*order)
    plain = events.withColumn("n", F.row_number().over(w).cast("bigint") - 1).withColumn(
        "s", F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    split = skew.running_total(events, keys, ["ts", "id"], "n", descending=descending)
    split = skew.running_total(split, keys, ["ts", "id"], "s", value=F.col("v"), descending=descending)
    assert table(split, "id", "n", "s") == table(plain, "id", "n", "s")


@pytest.mark.parametrize("following", [False, True])
def test_neighbour(events, chunking, following):
    shift = F.lead if following else F.lag
    w = Window.partitionBy("g").orderBy("ts", "id")
    plain = events.withColumn("p", shift("v").over(w)).withColumn("q", shift("ts").over(w))
    split = skew.neighbour(events, ["g"], ["ts", "id"], {"p": "v", "q": "ts"}, following=following)
    assert table(split, "id", "p", "q") == table(plain, "id", "p", "q")


def test_one_timestamp_for_all(spark, chunking):
    df = spark.range(500).select("id", F.lit(1).alias("g"), F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("ts"))
    numbered = skew.running_total(df, ["g"], ["ts", "id"], "n")
    assert table(numbered, "id", "n") == sorted(((i, i) for i in range(500)), key=repr)


def test_carried(events, chunking):
    rows = events.withColumn("x", F.when(F.col("id") % 11 == 0, F.col("v")))
    upto = Window.partitionBy("g").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.withColumn("known", F.last("x", ignorenulls=True).over(upto))
    split = skew.carried(rows, ["g"], ["ts", "id"], {"known": "x"})
    assert table(split, "id", "known") == table(plain, "id", "known")


def test_running_aggregates(events, chunking):
    events = events.withColumn("w", F.when(F.col("id") % 5 == 0, F.col("v")))
    before = Window.partitionBy("g").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, -1)
    made = {"a": ("sum", "v"), "b": ("min", "w"), "c": ("max", "w"), "d": ("last", "w")}
    plain = events.withColumns(
        {"a": F.coalesce(F.sum("v").over(before), F.lit(0)), "b": F.min("w").over(before), "c": F.max("w").over(before), "d": F.last("w", ignorenulls=True).over(before)}
    )
    split = skew.running(events, ["g"], ["ts", "id"], made)
    assert table(split, "id", *made) == table(plain, "id", *made)


def test_input_without_hot_groups_is_not_copied(events, chunking, spark, monkeypatch):
    spark.conf.set(skew.MAX_GROUP_ROWS, "2000")
    kept, keep = [], skew.keep
    monkeypatch.setattr(skew, "keep", lambda df, name: kept.append((name, df.count())) or keep(df, name))
    skew.neighbour(events, ["g"], ["ts", "id"], {"p": "v"}).collect()
    skew.running(events, ["g"], ["ts", "id"], {"a": ("sum", "v")}).collect()
    assert not any(rows for _, rows in kept)


def test_hot_groups_of_one_bucket_are_told_apart(events, chunking, spark, monkeypatch):
    monkeypatch.setattr(skew, "BUCKETS", 1)
    spark.conf.set(skew.MAX_GROUP_ROWS, "500")
    assert [r["g"] for r in skew.hot_groups(events, ["g"]).collect()] == [0]
    assert sorted(skew.neighbour(events, ["g"], ["ts", "id"], {"p": "v"}).columns) == ["g", "id", "p", "ts", "v"]
