"""Hot keys of a lookup whose sides are both too large to broadcast."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from starforge.operators import hot_keys, known_large, lookup, lookup_split
from starforge.session import Size, remember_size


@pytest.fixture
def no_broadcast(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def tables(spark, tmp_path):
    """A third of the rows has one key, a sixth none; the dimension is an aggregate."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 != 1, F.concat(F.lit("c"), F.col("id") % 997))
    spark.range(24_000).select(key.alias("k"), "id", (F.col("id") % 2).alias("DIM_K")) \
        .repartition(8).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    dim = fact.filter("k is not null and id % 5 > 0").groupBy(F.col("k").alias("DIM_K")).agg(F.min("id").alias("first"))
    return fact, dim


def test_hot_keys_by_share(spark, tables):
    fact, _ = tables
    assert hot_keys(fact, "k") == ["hot"]
    assert hot_keys(fact, F.upper("k"), 0.2) == ["HOT"]
    assert hot_keys(fact, "id") == [] and hot_keys(fact.filter("false"), "k") == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_lookup_equals_the_plain_one(spark, tables, how, no_broadcast):
    fact, dim = tables
    on = ("k", "DIM_K")
    got = lookup_split(fact, dim, on, ["first"], how)
    want = lookup(fact, dim, [on], ["first"], how, broadcast=False)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    for none in (fact.filter("false"), fact.filter("k is null")):
        assert lookup_split(none, dim, on, ["first"], how).count() == (none.count() if how == "left" else 0)
    assert lookup_split(fact, dim.filter("false"), on, ["first"], how).count() == (24_000 if how == "left" else 0)


def _rows_per_task(df):
    # ``first`` is used, or a left join to unique keys would be left out
    per = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max("first").alias("f"))
    return [r.n for r in per.collect()]


def test_hot_rows_spread_over_tasks(spark, tables, no_broadcast):
    fact, dim = tables
    rows = _rows_per_task(lookup_split(fact, dim, ("k", "DIM_K"), ["first"], "left"))
    before = _rows_per_task(lookup(fact, dim, [("k", "DIM_K")], ["first"], "left", broadcast=False))
    assert sum(rows) == sum(before) == 24_000
    assert max(rows) <= 2 * median(rows)
    assert max(before) >= 8_000                     # the whole hot key in one task


def test_a_dimension_known_to_be_large(spark):
    df = spark.createDataFrame([(1, "a")], "k int, t string")
    assert not known_large(df, ["k"])
    assert not known_large(remember_size(df.select("*"), Size(10, {"t": 10})), ["k", "t"])
    big = remember_size(df.select("*"), Size(2_000_000, {"t": 10}))
    assert known_large(big, ["k", "t"])
