"""Silver + gold dimensions -> gold facts (PL16-PL18).

Every fact keeps the grain of its source rows: clients are looked up
through ``client_map`` (one surviving key per client code), ticket types
through the full (type, status) natural key, product names through one
code per name.  Fact keys are dense ``bigint``s over a total order of the
output columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.functions import as_date, resolution_days
from starforge.operators import (known_large, lookup_split,
                                 Checked, Lookup, dense_key, enrich, fill_zero, identity_of, lookup,
                                 replace_column, require_in, role_join, split_by_reasons,
                                 union_by_name)
from starforge.plans.dims import products_by_name
from starforge.schemas import GOLD_COLUMNS
from starforge.session import materialize

SURVEY_SCHEMA = "cd_cliente string, dt_resposta date, ds_nota int, tipo_nps string, cd_prod string"


def contracts_base(history: DataFrame, contracts_12m: DataFrame, client_map: DataFrame,
                   dim_product: DataFrame, dim_time: DataFrame) -> DataFrame:
    """PL16 before numbering.  The client key and the 12-month metric (one
    row per client: the largest value, should an extract repeat a client)
    are first written as one client-grain table, so the fact has a single
    join on the client code, which AQE can split on a hot client; product
    and calendar are bounded lookups (broadcast behind a size check).  They
    come first: a code makes way for a number, the client adds two columns."""
    metric = contracts_12m.groupBy(F.col("cd_cliente").alias("CD_CLIENTE")).agg(
        F.max("vlr_contratacoes_12m").alias("vlr_contratacoes_12m"))
    clients = client_map.join(metric, "CD_CLIENTE", "left")
    df = lookup(history, dim_time, [(as_date("dt_upload"), "DATA")], ["SK_TEMPO"])
    df = lookup(df, dim_product, [("cd_prod", "CD_PRODUTO")], ["SK_PRODUTO"])
    df = lookup(df, materialize(clients, "client-grain"),
                [("cd_cliente", "CD_CLIENTE")], ["SK_CLIENTE", "vlr_contratacoes_12m"])
    out = df.select(
        "SK_CLIENTE", "SK_PRODUTO", "SK_TEMPO",
        F.col("vl_total").alias("VL_TOTAL_CONTRATO"),
        F.col("vl_desconto").alias("VL_DESCONTO"),
        F.col("vlr_contratacoes_12m").alias("VL_CONTRATACOES_12M"),
        *(identity_of(history) or []))
    return fill_zero(out, ["VL_CONTRATACOES_12M"])


def fact_contracts(history, contracts_12m, client_map, dim_product, dim_time) -> DataFrame:
    base = contracts_base(history, contracts_12m, client_map, dim_product, dim_time)
    return dense_key(base, "SK_CONTRATACAO", tiebreak=identity_of(base)) \
        .select(*GOLD_COLUMNS["fato_contratacoes"])


def tickets_base(tickets: DataFrame, client_map: DataFrame, dim_priority: DataFrame,
                 dim_ticket: DataFrame, dim_time: DataFrame) -> DataFrame:
    """PL17 before numbering."""
    t = replace_column(tickets, "TEMPO_RESOLUCAO_DIAS",
                       resolution_days(as_date("dt_atualizacao"), as_date("dt_criacao")))
    df = lookup(t, client_map, [("cd_cliente", "CD_CLIENTE")], ["SK_CLIENTE"])
    df = lookup(df, dim_priority, [("prioridade_ticket", "TIPO_PRIORIDADE")],
                ["SK_PRIORIDADE"])
    df = lookup(df, dim_ticket, [("tipo_ticket", "tipo_ticket"),
                                 ("status_ticket", "status_ticket")], ["sk_ticket"])
    df = role_join(df, dim_time, "DATA", "SK_TEMPO",
                   {"SK_TEMPO_CRIACAO": as_date("dt_criacao")})
    # the update date only has to exist in the calendar (its key is not kept)
    df = require_in(df, dim_time, [(as_date("dt_atualizacao"), "DATA")])
    return df.select("SK_CLIENTE", F.col("SK_TEMPO_CRIACAO").alias("SK_TEMPO"),
                     "SK_PRIORIDADE", F.col("sk_ticket").alias("SK_TICKET"),
                     F.col("tempo_resolucao_dias").alias("TEMPO_RESOLUCAO_DIAS"),
                     *(identity_of(tickets) or []))


def tickets_checked(tickets: DataFrame, client_map: DataFrame, dim_priority: DataFrame,
                    dim_ticket: DataFrame, dim_time: DataFrame) -> Checked:
    """The lookups of :func:`tickets_base` with the reasons of every dropped
    ticket: rows kept and rejected add up to the tickets."""
    return split_by_reasons(tickets, [
        Lookup("client", client_map, [("cd_cliente", "CD_CLIENTE")], {"_sk_client": "SK_CLIENTE"}),
        Lookup("priority", dim_priority, [("prioridade_ticket", "TIPO_PRIORIDADE")], {"_sk_priority": "SK_PRIORIDADE"}),
        Lookup("ticket", dim_ticket, [("tipo_ticket", "tipo_ticket"), ("status_ticket", "status_ticket")],
               {"_sk_ticket": "sk_ticket"}),
        Lookup("created", dim_time, [(as_date("dt_criacao"), "DATA")], {"_sk_time": "SK_TEMPO"}),
        Lookup("updated", dim_time, [(as_date("dt_atualizacao"), "DATA")]),
    ], "tickets_checked")


def fact_tickets(tickets, client_map, dim_priority, dim_ticket, dim_time) -> DataFrame:
    base = tickets_base(tickets, client_map, dim_priority, dim_ticket, dim_time)
    return dense_key(base, "SK_FATO_TICKET", tiebreak=identity_of(base)) \
        .select(*GOLD_COLUMNS["fato_tickets"])


def ticket_dates(tickets: DataFrame) -> DataFrame:
    """bk_ticket -> creation date, one row per ticket (earliest date,
    partially aggregated), so enriching an answer never multiplies it."""
    m = tickets.select("bk_ticket", as_date("dt_criacao").alias("dt_resposta"))
    return m.groupBy("bk_ticket").agg(F.min("dt_resposta").alias("dt_resposta"))


def support_enriched(support: DataFrame, tickets: DataFrame, split_hot: bool | None = None):
    """Support answers dated by their ticket's creation date.
    ``split_hot`` keeps answers of hot tickets out of the shuffle; by default
    where the tickets are known to be too many for a broadcast."""
    if known_large(tickets, ["bk_ticket", "dt_criacao"]) if split_hot is None else split_hot:
        return lookup_split(support, ticket_dates(tickets), ("bk_ticket", "bk_ticket"), ["dt_resposta"])
    return enrich(support, ticket_dates(tickets), "bk_ticket", "inner")


def product_enriched(product_nps: DataFrame, dim_product: DataFrame, split_hot: bool | None = None) -> DataFrame:
    """Product answers resolved to a product code by name; ``split_hot``
    as above, by the product dimension's size."""
    if known_large(dim_product, ["DS_PRODUTO", "CD_PRODUTO"]) if split_hot is None else split_hot:
        return lookup_split(product_nps, products_by_name(dim_product), ("nome_produto", "DS_PRODUTO"), ["CD_PRODUTO"])
    return lookup(product_nps, products_by_name(dim_product),
                  [("nome_produto", "DS_PRODUTO")], ["CD_PRODUTO"])


def unified_surveys(acquisition, onboarding, product, relational, support,
                    tickets, dim_product) -> DataFrame:
    """The five survey feeds as one polymorphic table."""
    branches = [acquisition, onboarding, product, relational, support]
    rid = identity_of(branches[0]) if all(identity_of(b) for b in branches) else None

    def std(df, prod=None):
        return df.select("cd_cliente", "dt_resposta", F.col("nota_nps").alias("ds_nota"),
                         "tipo_nps", (prod if prod is not None
                                      else F.lit(None).cast("string")).alias("cd_prod"),
                         *(rid or []))
    sup = std(support_enriched(support, tickets))
    prd = std(product_enriched(product, dim_product), F.col("CD_PRODUTO"))
    schema = _schema(SURVEY_SCHEMA + (", _rid_file bigint, _rid_row bigint" if rid else ""))
    return union_by_name([std(acquisition), std(onboarding), prd, std(relational), sup],
                         schema=schema)


def _schema(spec: str):
    from starforge.schemas import _schema as parse
    return parse(spec)


def nps_base(surveys: DataFrame, client_map: DataFrame, dim_time: DataFrame) -> DataFrame:
    """PL18 before numbering.  (The source's left join to the product
    dimension on the code keeps every row and none of its columns, so it
    is not performed.)"""
    df = lookup(surveys, client_map, [("cd_cliente", "CD_CLIENTE")], ["SK_CLIENTE"])
    df = lookup(df, dim_time, [(as_date("dt_resposta"), "DATA")], ["SK_TEMPO"])
    return df.select("SK_CLIENTE", "SK_TEMPO", F.col("ds_nota").alias("NOTA_NPS"),
                     F.col("tipo_nps").alias("TIPO_NPS"), *(identity_of(surveys) or []))


def fact_nps(surveys, client_map, dim_time) -> DataFrame:
    base = nps_base(surveys, client_map, dim_time)
    return dense_key(base, "SK_FATO_NPS", tiebreak=identity_of(base)) \
        .select(*GOLD_COLUMNS["fato_nps"])
