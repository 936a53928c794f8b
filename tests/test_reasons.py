"""Reject reasons of a chain of lookups, in one pass."""

from starforge.operators import Lookup, split_by_reasons
from starforge.plans import facts
from starforge.plans.warehouse import Warehouse


def test_every_failed_lookup_is_named(spark):
    fact = spark.createDataFrame([(1, "a", 10), (2, "z", 10), (3, None, 99), (4, "b", None), (4, "b", 20), (4, "b", 20)],
                                 "id int, code string, day int")
    codes = spark.createDataFrame([("a", 1), ("b", 2)], "k string, sk int")
    days = spark.createDataFrame([(10, 100), (20, 200)], "d int, sk int")
    got = split_by_reasons(fact, [Lookup("code", codes, [("code", "k")], {"sk_code": "sk"}),
                                  Lookup("day", days, [("day", "d")])])
    assert sorted(tuple(r) for r in got.kept.collect()) == [(1, "a", 10, 1), (4, "b", 20, 2), (4, "b", 20, 2)]
    bad = {r.id: r.reasons for r in got.quarantine.collect()}
    assert bad == {2: ["code"], 3: ["code", "day"], 4: ["day"]}
    assert (got.rows, got.rejected, got.failed) == (6, 3, {"code": 2, "day": 2})
    none = split_by_reasons(fact.filter("false"), [Lookup("code", codes, [("code", "k")])])
    assert (none.rows, none.rejected, none.failed) == (0, 0, {"code": 0}) and none.kept.count() == 0


def test_tickets_kept_and_rejected_add_up(spark, sf_small):
    w = Warehouse(spark, sf_small)
    args = (w.silver("tickets"), w.client_map(), w.dim_priority(), w.dim_ticket(), w.dim_time())
    got = facts.tickets_checked(*args)
    assert got.rows == w.silver("tickets").count() == got.kept.count() + got.quarantine.count()
    assert got.rejected == got.quarantine.count() > 0
    kept = got.kept.select("_sk_client", "_sk_time", "_sk_priority", "_sk_ticket")
    want = facts.tickets_base(*args).select("SK_CLIENTE", "SK_TEMPO", "SK_PRIORIDADE", "SK_TICKET")
    assert kept.exceptAll(want).count() == 0 and kept.count() == want.count()
