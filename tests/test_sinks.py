"""Parquet sinks, once-computed publishing and guarded steps."""

import pytest

from starforge.sinks import StepFailed, publish, run_step, write_parquet
from starforge.sources import read_csv, write_csv


def test_parquet_modes(spark, tmp_path):
    df = spark.range(5)
    p = str(tmp_path / "t")
    write_parquet(df, p, "overwrite")
    write_parquet(df, p, "append")
    assert spark.read.parquet(p).count() == 10
    write_parquet(df, p, "overwrite")
    assert spark.read.parquet(p).count() == 5


def test_publish_observes_rows(spark, tmp_path):
    res = publish(spark.range(42), str(tmp_path / "g"))
    assert res[0].ok and res[0].rows == 42


def test_run_step_names_the_failure():
    with pytest.raises(StepFailed, match="silver:x"):
        run_step("silver:x", lambda: 1 / 0)


def test_csv_glob_and_header(spark, tmp_path):
    from pyspark.sql.types import StructType, StructField, StringType
    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    df = spark.createDataFrame([("1", "x"), ("2", None)], schema)
    write_csv(df, str(tmp_path / "land_1"), sep=",")
    write_csv(df, str(tmp_path / "land_2"), sep=",")
    back = read_csv(spark, str(tmp_path / "land_*"), schema, sep=",")
    # both directories are read, each header skipped, empty cells are NULL
    got = sorted(((r.a, r.b) for r in back.collect()), key=lambda t: (t[0], t[1] or ""))
    assert got == [("1", "x"), ("1", "x"), ("2", None), ("2", None)]


def test_failed_jdbc_copy_does_not_block_parquet(spark, tmp_path):
    # no database is contacted: the URL names no driver, so the JDBC copy fails
    from starforge.sinks import JdbcTarget
    res = publish(spark.range(7), str(tmp_path / "g2"),
                  jdbc=JdbcTarget("jdbc:nodriver:nowhere", "T", "overwrite"))
    assert res[0].sink == "parquet" and res[0].ok and res[0].rows == 7
    assert res[1].sink == "jdbc" and not res[1].ok and res[1].error
    assert spark.read.parquet(str(tmp_path / "g2")).count() == 7


def test_csv_columns_are_found_by_header(spark, tmp_path):
    import pytest
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b")])
    path = tmp_path / "x.csv"
    path.write_text("b;extra;a\n1;x;C1\n")
    assert [tuple(r) for r in read_csv(spark, str(path), schema).collect()] == [("C1", "1")]
    with pytest.raises(ValueError, match="no column"):
        read_csv(spark, str(path), T.StructType([T.StructField("missing", T.StringType())]))


def test_failed_parquet_copy_blocks_the_others(spark, tmp_path):
    from pyspark.sql import functions as F
    from starforge.sinks.publish import JdbcTarget, publish
    bad = spark.range(3).select(F.raise_error(F.lit("boom")).alias("x"))
    res = publish(bad, str(tmp_path / "t"), JdbcTarget("jdbc:none:", "t"))
    assert [r.ok for r in res] == [False, False] and "Parquet copy failed" in res[1].error


def test_written_size_holds_for_its_own_files_only(spark, tmp_path):
    from starforge.session import written_size
    path = str(tmp_path / "t")
    read = lambda: written_size(spark.read.parquet(path), path)
    publish(spark.range(5), path)
    assert read().rows == 5
    spark.range(9).write.mode("overwrite").parquet(path)        # rewritten behind its back
    assert read() is None
    publish(spark.range(5), path)
    publish(spark.range(7), path, parquet_mode="append")
    assert read() is None


def test_scratch_tables_go_with_their_scope(spark):
    import os
    from starforge.session import materialize, scratch_scope
    with scratch_scope(spark):
        t = materialize(spark.range(3), "gone")
        path = os.path.dirname(t.inputFiles()[0].removeprefix("file://"))
        assert os.path.isdir(path)
    kept = materialize(spark.range(3), "kept")
    assert not os.path.exists(path) and kept.count() == 3
