"""Physical-plan summary of every medallion job: shuffles, broadcasts,
shuffle joins, sorts, aggregations and the columns each scan reads.

usage: python tools/plan_report.py [sf_dir]

The jobs are built over a freshly landed lake (so silver/gold inputs are
Parquet scans, as in production); plans are the initial physical plans
(AQE may still replace a shuffle join by a broadcast at run time).  A
dense key's numbering adds one range shuffle and one written table; its
second pass (keys from the written table) is listed separately.
"""
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from starforge import get_session  # noqa: E402
from starforge.plans import pipeline  # noqa: E402
from starforge.session import scratch_path  # noqa: E402
from starforge.sources import Layers  # noqa: E402


def summary(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin)",
                                   plan)),
        "range_shuffles": plan.count("rangepartitioning"),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "shuffle_joins": plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin"),
        "aggregations": len(re.findall(r"(Hash|Sort|ObjectHash)Aggregate\(", plan)) // 2,
        "single_partition": "SinglePartition" in plan,
        "scans": re.findall(r"ReadSchema: (struct<[^>]*>)", plan),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=16)
    layers = Layers(scratch_path(spark, "plan_report"))
    pipeline.land_bronze(spark, sf, layers)
    pipeline.run_silver(spark, layers)
    pipeline.run_gold(spark, layers)
    jobs = {f"silver:{e}": (lambda e=e: pipeline.SILVER_JOBS[e][1](
        pipeline.read_bronze(spark, layers, pipeline.SILVER_JOBS[e][0])))
        for e in pipeline.SILVER_JOBS if e != "clientes"}
    from starforge.operators import infer_product_map, with_row_identity
    from starforge.plans import dims, facts
    s = lambda e: pipeline.silver(spark, layers, e)
    r = lambda e: with_row_identity(s(e))
    g = lambda t: pipeline.gold(spark, layers, t)
    # inputs of the numbering step (each keyed table adds 1 range shuffle + 1 written table)
    jobs.update({
        "gold:dim_tempo (no key)": lambda: pipeline.DIM_BUILDERS["dim_tempo"](spark, layers),
        "gold:dim_produto (before key)": lambda: infer_product_map(s("historico"), s("clientes")),
        "gold:dim_prioridade (before key)": lambda: s("tickets").select("prioridade_ticket")
        .dropDuplicates(),
        "gold:fato_contratacoes (before key)": lambda: facts.contracts_base(
            r("historico"), s("contratacoes"), g(pipeline.CLIENT_KEY_MAP), g("dim_produto"),
            g("dim_tempo")),
        "gold:fato_tickets (before key)": lambda: facts.tickets_base(
            r("tickets"), g(pipeline.CLIENT_KEY_MAP), g("dim_prioridade"), g("dim_ticket"),
            g("dim_tempo")),
        "gold:fato_nps (before key)": lambda: facts.nps_base(facts.unified_surveys(
            r("nps_transacional_aquisicao"), r("nps_transacional_onboarding"),
            r("nps_transacional_produto"), r("nps_relacional"), r("nps_transacional_suporte"),
            s("tickets"), g("dim_produto")), g(pipeline.CLIENT_KEY_MAP), g("dim_tempo")),
        "gold:dim_cliente (keys read back)": lambda: dims.dim_client_keyed(r("clientes")),
    })
    for name, build in jobs.items():
        info = summary(build())
        scans = "; ".join(x[:70] for x in info.pop("scans"))
        print(f"{name:48s} " + " ".join(f"{k}={v}" for k, v in info.items())
              + f"  scans: {scans}")
    spark.stop()


if __name__ == "__main__":
    main()
