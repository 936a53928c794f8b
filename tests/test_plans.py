"""Plan shape: pruned scans, bounded dimensions broadcast, no fact-sized
single-partition exchange."""

from starforge.plans import catalog, facts
from starforge.plans.warehouse import Warehouse
from starforge.schemas import SILVER


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_staged_silver_holds_what_is_read(spark, sf_small):
    """A staged table keeps the columns that the query reads, a column more
    is an error; unnamed tables and warehouses without a list keep all."""
    w = catalog.W(spark, sf_small, "dim_time", historico=("nr_proposta",))
    assert w.silver("historico").columns == ["nr_proposta", "dt_upload"]
    assert w.silver("tickets").columns == ["dt_criacao"]
    assert w.silver("contratacoes").columns == SILVER["contratacoes"].names
    full = Warehouse(spark, sf_small)
    assert full.silver("historico").columns == SILVER["historico"].names
    assert sorted(w.dim_time().collect()) == sorted(full.dim_time().collect())
    wide = catalog.W(spark, sf_small, "dim_time", "client_map")
    assert sorted(wide.client_map().collect()) == sorted(full.client_map().collect())


def test_fact_plan_has_no_single_partition(spark, sf_small):
    w = Warehouse(spark, sf_small)
    for df in (w.fact_contracts(), w.fact_tickets(), w.fact_nps(), w.dim_client()):
        assert "SinglePartition" not in _plan(df)


def test_frames_before_numbering_have_no_single_partition(spark, sf_small):
    w = Warehouse(spark, sf_small)
    cal, clients = w.dim_time(), w.client_map()
    for df in (facts.contracts_base(w.silver("historico"), w.silver("contratacoes"), clients,
                                    w.dim_product(), cal),
               facts.tickets_base(w.silver("tickets"), clients, w.dim_priority(), w.dim_ticket(), cal),
               facts.nps_base(w.surveys(), clients, cal)):
        plan = _plan(df)
        assert "Join" in plan and "SinglePartition" not in plan


def test_bounded_dims_are_broadcast(spark, sf_small):
    w = Warehouse(spark, sf_small)
    base = facts.tickets_base(w.silver("tickets"), w.client_map(), w.dim_priority(),
                              w.dim_ticket(), w.dim_time())
    plan = _plan(base)
    assert plan.count("BroadcastHashJoin") >= 3


def test_silver_scan_is_pruned(spark, sf_small):
    w = Warehouse(spark, sf_small)
    df = w.silver("historico").select("cd_cliente", "cd_prod")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<cd_cliente:string,cd_prod:string>" in plan
