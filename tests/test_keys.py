"""Distributed dense keys against a brute-force global row_number."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starforge.operators import ROW_ID, dense_key, keys, with_row_identity


def _brute(df, name, order):
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn(name, F.row_number().over(w).cast("bigint"))


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a = rnd.choice([None, "a", "b", "c", "dd"])
        b = rnd.choice([None, 1.5, 2.5, -3.0])
        rows.append((a, b, rnd.randint(0, 20)))
    rows += [("hot", 1.0, 1)] * 1500          # one group of copies
    return spark.createDataFrame(rows, "a string, b double, c int")


def test_dense_key_equals_row_number(spark):
    df = _data(spark)
    got = dense_key(df, "k", order_by=["c"])
    want = _brute(df, "k", ["c", "a", "b"])
    assert _rows(got, ["k", "a", "b", "c"]) == _rows(want, ["k", "a", "b", "c"])
    ks = [r.k for r in got.select("k").collect()]
    assert sorted(ks) == list(range(1, df.count() + 1))


def test_hot_copy_group_is_chunked(spark, monkeypatch):
    monkeypatch.setattr(keys, "CHUNK", 100)
    df = _data(spark, n=500)
    got = dense_key(df, "k", order_by=["a"], num_partitions=8)
    want = _brute(df, "k", ["a", "b", "c"])
    assert _rows(got, ["k", "a", "b", "c"]) == _rows(want, ["k", "a", "b", "c"])


def test_unique_path_and_int_keys(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7 % 2000).alias("x"))
    got = dense_key(df, "k", unique=True, key_type="int")
    assert dict(got.dtypes)["k"] == "int"
    assert all(r.k == r.x + 1 for r in got.collect())


def test_tiebreak_path_matches(spark, tmp_path):
    df = _data(spark, n=1000)
    path = str(tmp_path / "t")
    df.repartition(4).write.parquet(path)
    src = with_row_identity(spark.read.parquet(path))
    got = dense_key(src, "k", order_by=["c"], tiebreak=ROW_ID)
    assert got.columns == ["k", "a", "b", "c"]
    want = _brute(spark.read.parquet(path), "k", ["c", "a", "b"])
    assert _rows(got, ["k", "a", "b", "c"]) == _rows(want, ["k", "a", "b", "c"])


def test_no_single_partition_exchange(spark):
    df = _data(spark, n=200)
    plan = dense_key(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_inputs(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("s"))
    assert [r.k for r in dense_key(df, "k").collect()] == list(range(1, n + 1))
