"""A key holding a third of all rows: lookups stay exact and AQE splits
the hot partition of a shuffle join (broadcast disabled on purpose)."""

from pyspark.sql import functions as F

from starforge.operators import attach_contract_span, lookup


def _skewed(spark, n=6000):
    rows = [("hot" if i % 3 == 0 else f"c{i % 97}", i) for i in range(n)]
    return spark.createDataFrame(rows, "cd_cliente string, v int")


def test_hot_key_lookup_is_exact_and_split(spark):
    fact = _skewed(spark).repartition(8, "v")
    dim = spark.createDataFrame([("hot", 1)] + [(f"c{i}", i + 2) for i in range(97)],
                                "CD_CLIENTE string, SK_CLIENTE int")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = lookup(fact, dim, [("cd_cliente", "CD_CLIENTE")], ["SK_CLIENTE"], broadcast=False)
        got = {r.cd_cliente: r.n for r in
               out.groupBy("cd_cliente").agg(F.count("*").alias("n")).collect()}
        assert got["hot"] == 2000 and sum(got.values()) == 6000
        assert len(out.collect()) == 6000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan
        assert "skew=true" in plan.replace(" ", "").lower() or "isSkew" in plan, plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_client_span_is_exact(spark):
    import datetime as dt
    rows = [("hot", dt.date(2020, 1, 1 + i % 28)) for i in range(3000)] + \
           [(f"c{i}", dt.date(2021, 1, 1)) for i in range(6000)]
    df = spark.createDataFrame(rows, "cd_cliente string, dt_assinatura_contrato date")
    out = attach_contract_span(df).filter(F.col("cd_cliente") == "hot") \
        .select("dt_inicio_contrato", "dt_ultimo_contrato").distinct().collect()
    assert [tuple(r) for r in out] == [(dt.date(2020, 1, 1), dt.date(2020, 1, 28))]


def test_contract_fact_does_not_multiply_on_repeated_12m_rows(spark, sf_small):
    from starforge.plans import facts
    from starforge.plans.warehouse import Warehouse
    w = Warehouse(spark, sf_small)
    twelve = w.silver("contratacoes")
    args = (w.client_map(), w.dim_product(), w.dim_time())
    once = facts.contracts_base(w.silver("historico"), twelve, *args)
    twice = facts.contracts_base(w.silver("historico"), twelve.unionByName(twelve), *args)
    assert once.count() == twice.count()
