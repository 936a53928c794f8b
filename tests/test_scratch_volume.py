"""What a write leaves on disk, and what goes through a shuffle for it."""

import os
import time

from pyspark.sql import functions as F

from starforge.operators import attach_contract_span, inference, with_row_identity
from starforge.plans import catalog, dims, facts
from starforge.plans.silver import with_contract_span
from starforge.plans.warehouse import Warehouse
from starforge.session import materialize, scratch_path, scratch_scope, shuffles_dropped

DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    out = materialize(spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count(), "dropped")
    for _ in range(100):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert out.count() == 7 and spark.conf.get(DROP) == "false"


def test_the_setting_returns_after_the_last_write(spark):
    with shuffles_dropped(spark):
        with shuffles_dropped(spark):
            assert spark.conf.get(DROP) == "true"
        assert spark.conf.get(DROP) == "true"
    assert spark.conf.get(DROP) == "false"


def test_a_scope_leaves_what_is_kept_to_the_outer_one(spark):
    here = lambda df: os.path.isdir(os.path.dirname(df.inputFiles()[0].removeprefix("file://")))
    with scratch_scope(spark):
        with scratch_scope(spark) as keep:
            gone, kept = materialize(spark.range(3), "inner"), keep(materialize(spark.range(4), "kept"))
            path = [os.path.dirname(t.inputFiles()[0].removeprefix("file://")) for t in (gone, kept)]
        assert [os.path.exists(p) for p in path] == [False, True] and kept.count() == 4 and here(kept)
    assert not os.path.exists(path[1])


CLIENTS = [("c1", "2000-01-05", "b"), ("c1", "2001-03-01", "c"), ("c1", "2001-03-01", "a"), ("c1", None, "a"),
           ("c2", None, "z"), ("c2", None, "y"), (None, "1999-01-01", "a"), ("c3", "2002-02-02", None),
           ("c3", "2002-02-02", None), ("c3", "1998-01-01", "k")]


def _clients(spark, tmp_path):
    texts = ["ds_segmento", "ds_subsegmento", "ds_prod", "fat_faixa", "uf", "cidade", "marca_totvs", "situacao_contrato"]
    df = spark.createDataFrame(CLIENTS, "cd_cliente string, d string, t string")
    df = df.select("cd_cliente", F.col("d").cast("date").alias("dt_assinatura_contrato"),
                   *[F.col("t").alias(c) for c in texts])
    df.write.parquet(str(tmp_path / "clients"))
    return spark.read.parquet(str(tmp_path / "clients"))


def test_rows_are_not_joined_to_a_span_that_nothing_reads(spark, tmp_path):
    df = _clients(spark, tmp_path)
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()      # noqa: E731
    spanned = attach_contract_span(df)
    assert "Join" not in plan(spanned.select("cd_cliente", "uf")) and "Join" in plan(spanned)
    got = {(r.cd_cliente, str(r.dt_inicio_contrato), str(r.dt_ultimo_contrato)) for r in spanned.collect()}
    assert got == {("c1", "2000-01-05", "2001-03-01"), ("c2", "None", "None"), (None, "None", "None"),
                   ("c3", "1998-01-01", "2002-02-02")}
    assert spanned.count() == len(CLIENTS)


def test_clients_are_numbered_alike_without_the_span(spark, tmp_path):
    spanned = with_contract_span(with_row_identity(_clients(spark, tmp_path)))
    keys = lambda d: sorted((r.CD_CLIENTE or "", r.SK_CLIENTE) for r in dims.client_keys(d).collect())     # noqa: E731
    whole = dims.dim_client_keyed(spanned)
    narrow = dims.dim_client_keyed(spanned, keep=["CD_CLIENTE", dims.SIGNED])
    assert narrow.columns == ["SK_CLIENTE", "CD_CLIENTE", dims.SIGNED]
    # the rows of a client ascend by text (NULL first), then by signing date
    assert keys(whole) == keys(narrow) == [("", 1), ("c1", 3), ("c2", 6), ("c3", 8)]


def test_the_client_map_leaves_no_numbered_rows(spark, sf_small):
    root = os.path.dirname(scratch_path(spark, "x").removeprefix("file:"))
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    w = Warehouse(spark, sf_small)
    first = sorted(tuple(r) for r in w.client_map().collect())
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(root)) - before}
    assert left == {"silver_clientes", "dim_cliente_chave"}
    w.dim_client().count()                      # built after it, from rows that are still there
    assert first == sorted(tuple(r) for r in w.client_map().collect()) and len(first) > 1


def test_sets_are_laid_out_together_and_large_ones_spread(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") < 20_000, F.lit("hot")).otherwise(
        F.concat(F.lit("p"), (F.col("id") % 500).cast("string"))).alias("code"), F.col("id").cast("string").alias("cd_cliente"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        at = inference._clustered(rows.repartition(8), "code").withColumn("p", F.spark_partition_id()).groupBy("code").agg(
            F.count_distinct("p").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    n = {r.code: r.n for r in at}
    assert n["hot"] >= 3 and max(v for k, v in n.items() if k != "hot") <= 2 and len(n) == 501


def test_ticket_rejects_stage_what_they_read(spark, sf_small, monkeypatch):
    real, seen = facts.tickets_checked, []
    monkeypatch.setattr(facts, "tickets_checked", lambda t, *dims: seen.append(t.columns) or real(t, *dims))
    got = catalog.REGISTRY["fact_tickets_rejects"].run(spark, sf_small)
    assert seen and "nome_grupo" not in seen[0] and "bk_ticket" in seen[0]
    assert got.columns == ["bk_ticket", "reasons"] and got.count() > 0
