"""Silver -> gold dimensions (PL11-PL15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.functions import calendar_attributes
from starforge.operators import (dense_key, drop_duplicates_all, identity_of,
                                 infer_product_map, keep_one, observed_dates,
                                 surrogate_key, to_gold_names)
from starforge.schemas import GOLD_COLUMNS
from starforge.session import known_size, remember_size, scratch_scope

SIGNED = "DT_ASSINATURA_CONTRATO"
SPAN = ("DT_ULTIMO_CONTRATO", "DT_INICIO_CONTRATO")     # of the client, on each of its rows


def dim_time(clients: DataFrame, tickets: DataFrame, history: DataFrame,
             extra_dates: list[tuple[DataFrame, str]] | None = None,
             sort: bool = True) -> DataFrame:
    """PL11: calendar of the dates observed as last contract date, ticket
    creation date and proposal upload date (plus ``extra_dates``), keyed
    by the smart key ``yyyyMMdd``.  Its size is bounded by the date span,
    not by the data volume.  ``clients`` may be the contract rows or the
    per-client rollup: only its ``dt_ultimo_contrato`` column is read."""
    dates = observed_dates((clients, "dt_ultimo_contrato"), (tickets, "dt_criacao"),
                           (history, "dt_upload"), *(extra_dates or []))
    cal = dates.select(*calendar_attributes("DATA"))
    return cal.orderBy("SK_TEMPO") if sort else cal


def dim_client_keyed(clients: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The rows of PL12 with the signing date of their contract, which only
    :func:`client_keys` reads: SK_CLIENTE numbered by client code, ties
    broken by all other columns, the signing date last.  ``keep``: columns to
    write beside the key.  The contract span is the same on all rows of a
    client, whose code comes first, so it decides nothing and goes through
    the numbering only if it is written."""
    rid = identity_of(clients)
    names = [c for c in GOLD_COLUMNS["dim_cliente"][1:] if keep is None or c in keep or c not in SPAN]
    gold = to_gold_names(clients, names + [SIGNED] + (rid or []))
    return dense_key(gold, "SK_CLIENTE", order_by=["CD_CLIENTE"], key_type="bigint",
                     tiebreak=rid, keep=keep)


def dim_client(keyed: DataFrame) -> DataFrame:
    """PL12: one row per contract row (the source keeps that grain on
    purpose), from :func:`dim_client_keyed`."""
    return _gold(keyed, "dim_cliente")


def client_keys(keyed: DataFrame) -> DataFrame:
    """One surviving key per client code for fact lookups: the client's
    latest contract, then the lowest remaining columns, which is the
    smallest key among them (a partial aggregation, no window)."""
    signed = F.col(SIGNED)
    best = F.min(F.struct(signed.isNull(), -F.unix_date(signed), F.col("SK_CLIENTE").alias("key")))
    keys = keyed.groupBy("CD_CLIENTE").agg(best.alias("best"))
    out = keys.select("CD_CLIENTE", F.col("best.key").alias("SK_CLIENTE"))
    return remember_size(out, known_size(keyed))    # an upper bound: at most one row per row


def _gold(keyed: DataFrame, table: str) -> DataFrame:
    return remember_size(keyed.select(*GOLD_COLUMNS[table]), known_size(keyed))


def dim_product(history: DataFrame, clients: DataFrame) -> DataFrame:
    """PL13: product codes with their inferred description and revenue line."""
    with scratch_scope(history.sparkSession) as keep:       # the numbered rows alone stay
        keyed = keep(surrogate_key(infer_product_map(history, clients), "SK_PRODUTO", ["CD_PRODUTO"]))
    return _gold(keyed, "dim_produto")


def products_by_name(dim: DataFrame) -> DataFrame:
    """Name-keyed view of the product dimension: one code per description
    (the smallest), so a lookup by name never multiplies rows."""
    named = remember_size(dim.select("DS_PRODUTO", "CD_PRODUTO", "SK_PRODUTO"), known_size(dim))
    return keep_one(named, ["DS_PRODUTO"], ["CD_PRODUTO"])


def dim_priority(tickets: DataFrame) -> DataFrame:
    """PL14: distinct ticket priorities."""
    d = drop_duplicates_all(tickets.select(F.col("prioridade_ticket").alias("TIPO_PRIORIDADE")))
    return _gold(surrogate_key(d, "SK_PRIORIDADE", ["TIPO_PRIORIDADE"]), "dim_prioridade")


def dim_ticket(tickets: DataFrame) -> DataFrame:
    """PL15: junk dimension of distinct (type, status) pairs."""
    d = drop_duplicates_all(tickets.select("tipo_ticket", "status_ticket"))
    return _gold(surrogate_key(d, "sk_ticket", ["tipo_ticket", "status_ticket"]), "dim_ticket")
