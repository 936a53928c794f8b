"""Lookups return fact columns + requested keys; broadcast only after a
size check; semi/anti joins never multiply rows."""

from pyspark.sql import functions as F

from starforge.operators import (broadcast_if_small, lookup, rejects,
                                 require_in, role_join)
from starforge.operators.lookup import bytes_bound, fits_broadcast
from starforge.session import materialize


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _facts(spark):
    return spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (2, "y")], "k int, v string")


def _dim(spark):
    return spark.createDataFrame([(1, 10), (2, 20), (4, 40)], "DK int, SK int")


def test_lookup_columns_and_inner(spark):
    out = lookup(_facts(spark), _dim(spark), [("k", "DK")], ["SK"])
    assert out.columns == ["k", "v", "SK"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", 10), (2, "y", 20), (2, "y", 20)]


def test_left_lookup_keeps_rows(spark):
    out = lookup(_facts(spark), _dim(spark), [("k", "DK")], ["SK"], how="left")
    assert out.count() == 4


def test_broadcast_only_when_small(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        written = materialize(_dim(spark), "dim")
        hinted = lookup(_facts(spark), written, [("k", "DK")], ["SK"], max_rows=10)
        assert "BroadcastHashJoin" in _plan(hinted)
        for dim, rows in ((written, 1), (_dim(spark), 10)):     # too large; of unknown size
            unhinted = lookup(_facts(spark), dim, [("k", "DK")], ["SK"], max_rows=rows)
            assert "BroadcastHashJoin" not in _plan(unhinted)
        assert "BroadcastHashJoin" not in _plan(_facts(spark).join(
            broadcast_if_small(_dim(spark), 0), F.col("k") == F.col("DK")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_semi_and_anti(spark):
    f, d = _facts(spark), _dim(spark)
    assert sorted(r.k for r in require_in(f, d, [("k", "DK")]).collect()) == [1, 2, 2]
    assert [r.k for r in rejects(f, d, [("k", "DK")]).collect()] == [3]


def test_role_join(spark):
    f = spark.createDataFrame([(1, 2), (2, 4)], "a int, b int")
    out = role_join(f, _dim(spark), "DK", "SK", {"SK_A": "a", "SK_B": "b"})
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2, 10, 20), (2, 4, 20, 40)]


def test_lookup_can_take_the_key_itself(spark):
    out = lookup(_facts(spark), _dim(spark), [("k", "DK")], ["DK", "SK"])
    assert out.columns == ["k", "v", "DK", "SK"]
    assert all(r.k == r.DK for r in out.collect())


def test_bound_counts_wide_text(spark):
    wide = materialize(spark.range(2000).select("id", F.repeat(F.lit("x"), 4000).alias("t")), "wide")
    assert bytes_bound(wide, ["id", "t"]) >= 2000 * 4000 > bytes_bound(wide, ["id"])
    assert not fits_broadcast(wide, ["id", "t"], max_bytes=1 << 20)
    assert fits_broadcast(wide, ["id"], max_bytes=1 << 20)
    nested = materialize(spark.range(3).select(F.array("id").alias("a")), "nested")
    assert bytes_bound(nested, ["a"]) is None
