"""Invariants of the star schema on the sf0.001 tables."""

import pytest
from pyspark.sql import functions as F

from starforge.functions import as_date
from starforge.operators import rejects, require_in
from starforge.plans import dims
from starforge.plans.warehouse import Warehouse


@pytest.fixture(scope="module")
def w(spark, sf_small):
    return Warehouse(spark, sf_small)


def _dense(df, key):
    ks = sorted(r[0] for r in df.select(key).collect())
    return ks == list(range(1, len(ks) + 1))


def test_dimension_keys_dense_and_unique(w):
    assert _dense(w.dim_client(), "SK_CLIENTE")
    assert _dense(w.dim_product(), "SK_PRODUTO")
    assert _dense(w.dim_priority(), "SK_PRIORIDADE")
    assert _dense(w.dim_ticket(), "sk_ticket")
    cal = w.dim_time()
    assert cal.count() == cal.select("SK_TEMPO").distinct().count()


def test_fact_keys_dense(w):
    assert _dense(w.fact_contracts(), "SK_CONTRATACAO")
    assert _dense(w.fact_tickets(), "SK_FATO_TICKET")
    assert _dense(w.fact_nps(), "SK_FATO_NPS")


def test_contract_fact_has_no_fan_out(w):
    h = w.silver("historico")
    keys = w.client_map()
    # rows of the input that no lookup rejects == rows of the fact
    kept = require_in(require_in(require_in(
        h, keys, [("cd_cliente", "CD_CLIENTE")]),
        w.dim_product(), [("cd_prod", "CD_PRODUTO")]),
        w.dim_time(), [(as_date("dt_upload"), "DATA")])
    rejected = rejects(h, w.dim_time(), [(as_date("dt_upload"), "DATA")]).count()
    assert rejected > 0                      # the bad upload dates are really dropped
    assert w.fact_contracts().count() == kept.count()
    strays = rejects(h, keys, [("cd_cliente", "CD_CLIENTE")]).count()
    assert h.count() - rejected - strays <= kept.count() < h.count() - strays


def test_ticket_fact_keeps_ticket_grain(w):
    assert w.fact_tickets().count() <= w.silver("tickets").count()


def test_every_foreign_key_resolves(w):
    fc = w.fact_contracts()
    for fk, dim, key in [("SK_CLIENTE", w.dim_client(), "SK_CLIENTE"),
                         ("SK_PRODUTO", w.dim_product(), "SK_PRODUTO"),
                         ("SK_TEMPO", w.dim_time(), "SK_TEMPO")]:
        assert fc.join(dim.select(F.col(key).alias(fk)), fk, "left_anti").count() == 0
    ft = w.fact_tickets()
    assert ft.join(w.dim_ticket().select(F.col("sk_ticket").alias("SK_TICKET")), "SK_TICKET",
                   "left_anti").count() == 0


def test_inferred_map_covers_every_code_with_contract_clients(w):
    h = w.silver("historico").select("cd_cliente", "cd_prod")
    with_contracts = h.join(w.clients_raw().select("cd_cliente").distinct(), "cd_cliente")
    codes = with_contracts.select(F.col("cd_prod").alias("CD_PRODUTO")).distinct()
    assert codes.join(w.dim_product(), "CD_PRODUTO", "left_anti").count() == 0


def test_calendar_holds_only_observed_dates(w):
    assert w.dim_time().filter(F.col("DATA").isNull()).count() == 0


def test_surviving_client_key_is_the_latest_contract(w):
    rows = w.client_rows().select("CD_CLIENTE", dims.SIGNED, "SK_CLIENTE").collect()
    best = {}
    for code, signed, key in rows:
        rank = (signed is None, -signed.toordinal() if signed else 0, key)
        best[code] = min(best.get(code, rank), rank)
    assert {r.CD_CLIENTE: r.SK_CLIENTE for r in w.client_map().collect()} == {c: b[2] for c, b in best.items()}


def test_every_lookup_rejects_something(w):
    h, t, cal = w.silver("historico"), w.silver("tickets"), w.dim_time()
    assert rejects(h, w.client_map(), [("cd_cliente", "CD_CLIENTE")]).count() > 0
    assert rejects(h, w.dim_product(), [("cd_prod", "CD_PRODUTO")]).count() > 0
    assert rejects(t, w.client_map(), [("cd_cliente", "CD_CLIENTE")]).count() > 0
    assert rejects(t, cal, [(as_date("dt_atualizacao"), "DATA")]).count() > 0
    assert t.filter(F.col("bk_ticket") > 2 ** 53).count() > 0


def test_inference_recovers_known_truth(w):
    # in the test mapping the description suffix is the product code
    d = w.dim_product()
    ok = d.filter(F.element_at(F.split("DS_PRODUTO", " #"), -1) == F.col("CD_PRODUTO")).count()
    assert ok == d.count() > 0
