"""Versioned tables, resumable sinks and keys that last across runs."""

import os

import pytest
from pyspark.sql import functions as F

from starforge.operators import new_keys
from starforge.plans.pipeline import extend_dim
from starforge.session import known_size
from starforge.sinks.versioned import (current, feed_sinks, read_version, remove_orphans, versions,
                                       write_version)


def _ids(df):
    return sorted(r[0] for r in df.collect())


def test_a_write_that_dies_leaves_the_old_table(spark, tmp_path):
    p = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_version(spark, p)
    write_version(spark.range(5), p)
    bad = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(
        F.raise_error(F.lit("boom"))).alias("id"))
    with pytest.raises(Exception, match="boom"):
        write_version(bad, p)
    assert _ids(read_version(spark, p)) == list(range(5)) and len(versions(spark, p)) == 1
    # the dead writer's folder goes once it is old enough, the table's stays
    assert remove_orphans(spark, p, 3600) == []
    assert len(remove_orphans(spark, p, -5)) == 1
    assert _ids(read_version(spark, p)) == list(range(5))


def test_a_reader_sees_one_version(spark, tmp_path):
    p = str(tmp_path / "t")
    write_version(spark.range(5), p)
    old = read_version(spark, p)                    # resolved before the next write
    write_version(spark.range(7), p)
    assert _ids(old) == list(range(5)) and _ids(read_version(spark, p)) == list(range(7))
    write_version(spark.range(100, 102), p, "append")
    assert _ids(read_version(spark, p)) == [*range(7), 100, 101]
    assert current(spark, p).counts == [7, 2]
    assert known_size(read_version(spark, p)).rows == 9
    with pytest.raises(ValueError, match="other columns"):
        write_version(spark.range(3).toDF("x"), p, "append")


def test_expired_versions_go_with_their_data(spark, tmp_path):
    p = tmp_path / "t"
    for n in (1, 2, 3, 4):
        write_version(spark.range(n), str(p), keep=2)
    assert [v.number for v in versions(spark, str(p))] == [3, 4]
    assert len([x for x in os.listdir(p) if x.startswith("data-")]) == 2
    write_version(spark.range(1), str(p), "append", keep=1)     # lists version 4's data: it stays
    assert read_version(spark, str(p)).count() == 5 and len([x for x in os.listdir(p) if x.startswith("data-")]) == 2


def test_two_writers_both_commit(spark, tmp_path):
    """Commits meet on the same number: one waits for the other, none is lost."""
    from concurrent.futures import ThreadPoolExecutor
    p = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: write_version(spark.range(10 * k, 10 * k + 10), p, "append", keep=10), range(4)))
    assert _ids(read_version(spark, p)) == list(range(40))
    assert [v.number for v in versions(spark, p)] == [1, 2, 3, 4]


def sink_into(rows):
    return lambda df, mode: rows.append((mode, _ids(df)))


def test_a_rerun_repeats_only_failed_sinks(spark, tmp_path):
    p = str(tmp_path / "t")
    got, fail = {"a": [], "b": []}, {"b"}

    def sink(name):
        def write(df, mode):
            if name in fail:
                raise RuntimeError("down")
            got[name].append((mode, _ids(df)))
        return write
    sinks = {n: sink(n) for n in got}
    write_version(spark.range(3), p)
    res = {r.sink: (r.ok, r.rows) for r in feed_sinks(spark, p, sinks)}
    assert res == {"a": (True, 3), "b": (False, 0)}
    write_version(spark.range(10, 12), p, "append")
    fail.clear()
    res = {r.sink: (r.ok, r.rows) for r in feed_sinks(spark, p, sinks)}
    assert res == {"a": (True, 2), "b": (True, 5)}
    # only the rows that each write added, never the whole table again
    assert got["a"] == got["b"] == [("overwrite", [0, 1, 2]), ("append", [10, 11])]
    assert all(r.rows == 0 for r in feed_sinks(spark, p, sinks)) and len(got["a"]) == 2
    # a sink that slept through expired versions still gets every row
    for k in range(4):
        write_version(spark.range(k, k + 1), p, "append", keep=1)
    assert feed_sinks(spark, p, {"c": sink_into(got.setdefault("c", []))})[0].rows == 9
    write_version(spark.range(2), p)
    feed_sinks(spark, p, sinks)
    assert got["a"][-1] == ("overwrite", [0, 1])


def test_appended_dimensions_keep_their_keys(spark, tmp_path):
    p = str(tmp_path / "dim")
    schema = "code string, kind string, text string"
    one = spark.createDataFrame([("b", None, "x"), ("a", "k", "y"), ("a", "k", "z")], schema)
    two = spark.createDataFrame([("b", None, "new"), (None, None, "n"), ("aa", "k", "q"), ("a", "k", "y")], schema)
    extend_dim(one, p, "SK", ["code", "kind"])
    first = {(r.code, r.kind): (r.SK, r.text) for r in read_version(spark, p).collect()}
    assert first == {("a", "k"): (1, "y"), ("b", None): (2, "x")}
    extend_dim(two, p, "SK", ["code", "kind"])
    extend_dim(two, p, "SK", ["code", "kind"])              # a rerun adds nothing
    rows = [(r.SK, r.code, r.kind) for r in read_version(spark, p).collect()]
    assert sorted(rows) == [(1, "a", "k"), (2, "b", None), (3, None, None), (4, "aa", "k")]


def test_keys_survive_a_run_that_dies_between_its_commits(spark, tmp_path):
    p = str(tmp_path / "dim")
    a = spark.createDataFrame([("a",), ("b",)], "code string")
    write_version(new_keys(a, None, "SK", ["code"]), f"{p}_chaves", "append")      # the dimension was not written
    extend_dim(spark.createDataFrame([("c",), ("b",)], "code string"), p, "SK", ["code"])
    assert sorted(tuple(r) for r in read_version(spark, p).collect()) == [(2, "b"), (3, "c")]
    extend_dim(a, p, "SK", ["code"])
    assert sorted(tuple(r) for r in read_version(spark, p).collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert current(spark, p).rows == 3
