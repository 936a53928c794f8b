"""Bronze -> silver jobs (PL1-PL10): one projection each (rename, ANSI-safe
parse, null policy, discriminator), no shuffle except the per-client
contract span of PL1.  Functions take and return DataFrames; I/O lives
in :mod:`starforge.plans.pipeline`.

The names come from the fixed tables in :mod:`starforge.schemas`
(``RENAMES``, ``FILL_TEXT``, ``FILL_SCORE``); this module only says how
each column is parsed from its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from starforge.functions import (as_date, decimal_comma, parse_date,
                                 parse_date_us, parse_ts_date, resolution_days,
                                 to_double, to_int, to_long)
from starforge.functions.parsing import ISO_DATE
from starforge.operators import (ROW_ID, ParseAudit, attach_contract_span, fill_missing_score,
                                 fill_unknown, tag)
from starforge.operators.shaping import col
from starforge.schemas import FILL_SCORE, FILL_TEXT, NPS_TAGS, RENAMES, SILVER


def _iso(c):
    return parse_date(c, ISO_DATE)


# how each silver column is parsed from its text; unlisted columns stay
# text, except survey sub-scores, which are numbers (to_double)
PARSERS = {
    "dados_clientes": {"dt_assinatura_contrato": _iso, "vl_total_contrato": decimal_comma},
    "contratacoes_ultimos_12_meses": {"qtd_contratacoes_12m": to_int,
                                      "vlr_contratacoes_12m": decimal_comma},
    "historico": {"item_proposta": to_int, "dt_upload": _iso, "qtd": decimal_comma,
                  "meses_bonif": to_int, "vl_total": decimal_comma, "vl_full": decimal_comma,
                  "vl_desconto": decimal_comma},
    "tickets": {"bk_ticket": to_long, "dt_criacao": _iso, "dt_atualizacao": _iso},
    "telemetria": {"duracao_evento": to_double, "dt_referencia": as_date},
    "nps_relacional": {"dt_resposta": as_date, "nota_nps": to_int},
    "nps_transacional_produto": {"dt_resposta": parse_date_us, "nota_nps": to_int},
    "nps_transacional_aquisicao": {"dt_resposta": _iso, "nota_nps": to_int},
    "nps_transacional_onboarding": {"dt_resposta": parse_ts_date, "nota_nps": to_int},
    "nps_transacional_suporte": {"bk_ticket": to_long, "nota_nps": to_int},
}


def _parser(extract: str, column: str):
    if column in PARSERS[extract]:
        return PARSERS[extract][column]
    if column in FILL_SCORE.get(extract, ()):
        return to_double
    return lambda c: c


def parsed_columns(extract: str) -> list[str]:
    """The silver columns of an extract that are read from text by a parser."""
    return [dst for _, dst in RENAMES[extract]
            if dst in PARSERS[extract] or dst in FILL_SCORE.get(extract, ())]


def clean(bronze: DataFrame, extract: str, audit: ParseAudit | None = None) -> DataFrame:
    """Rename, parse and null-fill one extract in a single projection;
    ``audit`` counts the texts that became NULL, before the fills."""
    parsed = {dst: _parser(extract, dst)(col(src)) for src, dst in RENAMES[extract]}
    if audit is None:
        df = bronze.select(*[e.alias(dst) for dst, e in parsed.items()])
    else:
        source = {dst: src for src, dst in RENAMES[extract]}
        df = audit.watch(bronze, parsed, {dst: col(source[dst]) for dst in parsed_columns(extract)})
    if extract in FILL_TEXT:
        df = fill_unknown(df, FILL_TEXT[extract])
    if extract in FILL_SCORE:
        df = fill_missing_score(df, FILL_SCORE[extract])
    if extract in NPS_TAGS:
        df = tag(df, "tipo_nps", NPS_TAGS[extract])
    return df


def _ordered(df: DataFrame, entity: str) -> DataFrame:
    return df.select(*SILVER[entity].names)


def silver_clients_raw(bronze: DataFrame, audit: ParseAudit | None = None) -> DataFrame:
    """PL1 without the contract span: parsed, renamed, null-filled."""
    return clean(bronze, "dados_clientes", audit)


def with_contract_span(raw: DataFrame) -> DataFrame:
    """Add each client's first and last contract date to every row (a
    source-row identity on ``raw`` is kept, as are columns left out of it)."""
    spanned = attach_contract_span(raw)
    return spanned.select(*[c for c in [*SILVER["clientes"].names, *ROW_ID] if c in spanned.columns])


def silver_clients(bronze: DataFrame, with_span: bool = True,
                   audit: ParseAudit | None = None) -> DataFrame:
    """PL1: contract rows.  ``with_span`` adds each client's first and last
    contract date to every row (consumed by the client and calendar
    dimensions)."""
    raw = silver_clients_raw(bronze, audit)
    return with_contract_span(raw) if with_span else raw


def silver_contracts_12m(bronze: DataFrame, audit: ParseAudit | None = None) -> DataFrame:
    """PL2: the pre-aggregated 12-month contract rollup."""
    return _ordered(clean(bronze, "contratacoes_ultimos_12_meses", audit), "contratacoes")


def silver_history(bronze: DataFrame, audit: ParseAudit | None = None) -> DataFrame:
    """PL3: proposal items."""
    return _ordered(clean(bronze, "historico", audit), "historico")


def silver_tickets(bronze: DataFrame, audit: ParseAudit | None = None) -> DataFrame:
    """PL4: support tickets with the resolution time in days."""
    df = clean(bronze, "tickets", audit)
    df = df.withColumn("tempo_resolucao_dias", resolution_days("dt_atualizacao", "dt_criacao"))
    return _ordered(df, "tickets")


def silver_telemetry(bronze: DataFrame, audit: ParseAudit | None = None) -> DataFrame:
    """PL5: product telemetry (read by no gold job)."""
    return _ordered(clean(bronze, "telemetria", audit), "telemetria")


def silver_nps_relational(bronze: DataFrame, audit: ParseAudit | None = None) -> DataFrame:
    """PL6: relational survey."""
    return _ordered(clean(bronze, "nps_relacional", audit), "nps_relacional")


def silver_nps_product(bronze: DataFrame, audit: ParseAudit | None = None) -> DataFrame:
    """PL7: product survey (US date-time with meridiem)."""
    return _ordered(clean(bronze, "nps_transacional_produto", audit), "nps_transacional_produto")


def silver_nps_acquisition(bronze: DataFrame, audit: ParseAudit | None = None) -> DataFrame:
    """PL8: acquisition survey (ISO date)."""
    return _ordered(clean(bronze, "nps_transacional_aquisicao", audit), "nps_transacional_aquisicao")


def silver_nps_onboarding(bronze: DataFrame, audit: ParseAudit | None = None) -> DataFrame:
    """PL9: onboarding survey (ISO-T timestamp reduced to a date)."""
    return _ordered(clean(bronze, "nps_transacional_onboarding", audit),
                    "nps_transacional_onboarding")


def silver_nps_support(bronze: DataFrame, audit: ParseAudit | None = None) -> DataFrame:
    """PL10: support survey (no date of its own; keyed by ticket)."""
    return _ordered(clean(bronze, "nps_transacional_suporte", audit), "nps_transacional_suporte")


SILVER_JOBS = {
    "clientes": ("dados_clientes", silver_clients),
    "contratacoes": ("contratacoes_ultimos_12_meses", silver_contracts_12m),
    "historico": ("historico", silver_history),
    "tickets": ("tickets", silver_tickets),
    "telemetria": ("telemetria", silver_telemetry),
    "nps_relacional": ("nps_relacional", silver_nps_relational),
    "nps_transacional_produto": ("nps_transacional_produto", silver_nps_product),
    "nps_transacional_aquisicao": ("nps_transacional_aquisicao", silver_nps_acquisition),
    "nps_transacional_onboarding": ("nps_transacional_onboarding", silver_nps_onboarding),
    "nps_transacional_suporte": ("nps_transacional_suporte", silver_nps_support),
}
