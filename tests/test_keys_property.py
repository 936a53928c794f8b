"""Property: for any rows (NULLs, copies, negative zero excluded), the
distributed dense key gives exactly the multiset of (row, key) pairs of a
global row_number over the same total order."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starforge.operators import dense_key

ROW = st.tuples(st.one_of(st.none(), st.sampled_from(["", "a", "b", "Z", "é"])),
                st.one_of(st.none(), st.integers(-5, 5)),
                st.one_of(st.none(), st.floats(-2, 2, allow_nan=False).filter(lambda x: x != 0)))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, max_size=60), copies=st.integers(0, 40))
def test_dense_key_matches_row_number(spark, rows, copies):
    rows = rows + [("a", 1, 0.5)] * copies
    df = spark.createDataFrame(rows, "s string, i int, d double")
    got = sorted(tuple(r) for r in dense_key(df, "k", order_by=["i"]).collect())
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in ["i", "s", "d"]])
    want = sorted(tuple(r) for r in df.select(F.row_number().over(w).cast("bigint").alias("k"),
                                              "s", "i", "d").collect())
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=50), copies=st.integers(0, 30),
       parts=st.integers(1, 4))
def test_dense_key_tiebreak_matches_row_number(spark, tmp_path_factory, rows, copies, parts):
    from starforge.operators import ROW_ID, with_row_identity
    rows = rows + [("a", 1, 0.5)] * copies
    path = str(tmp_path_factory.mktemp("tb"))
    spark.createDataFrame(rows, "s string, i int, d double").repartition(parts) \
        .write.mode("overwrite").parquet(path)
    src = spark.read.parquet(path)
    got = sorted(tuple(r) for r in dense_key(with_row_identity(src), "k", order_by=["i"],
                                             tiebreak=ROW_ID).collect())
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in ["i", "s", "d"]])
    want = sorted(tuple(r) for r in src.select(F.row_number().over(w).cast("bigint").alias("k"),
                                               "s", "i", "d").collect())
    assert got == want
