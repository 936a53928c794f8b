"""Equivalent DuckDB SQL for the registered queries.

Each statement re-derives its result from the driver's tables (views
``lineitem orders customer nation part events`` ...) independently of the
Spark code: bronze extracts as text, silver parsing with DuckDB's own
``TRY_CAST`` / ``try_strptime``, and gold keys with a global
``row_number`` over the same total order the distributed key uses
(ascending, NULLs first).  A shared ``WITH`` prefix defines every layer;
DuckDB only evaluates the parts a statement references.
"""

from __future__ import annotations

from starforge.schemas import BRONZE, FILL_SCORE, GOLD_COLUMNS, RENAMES, SILVER


def money(c: str, sep: str = ",") -> str:
    return (f"(CAST(({c}) // 100 AS VARCHAR) || '{sep}' || "
            f"lpad(CAST(({c}) % 100 AS VARCHAR), 2, '0'))")


def thousands(c: str) -> str:
    ip = f"(({c}) // 100)"
    return (f"(CAST({ip} // 1000 AS VARCHAR) || '.' || lpad(CAST({ip} % 1000 AS VARCHAR), 3, '0')"
            f" || ',' || lpad(CAST(({c}) % 100 AS VARCHAR), 2, '0'))")


def cents(x: str) -> str:
    return f"CAST(round(({x}) * 100) AS BIGINT)"


def dtext(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d')"


def score(i: int) -> str:
    v = f"((event_id + {i}) % 5)"
    return f"CASE WHEN {v} = 0 THEN NULL ELSE CAST({v} AS VARCHAR) END"


NOTA = ("CASE WHEN event_id % 13 = 0 THEN CAST(event_id % 11 AS VARCHAR) || '.0' "
        "ELSE CAST(event_id % 11 AS VARCHAR) END")


def q(name: str) -> str:
    return '"' + name + '"'


def _scores(entity: str, start: int, stop: int | None = None) -> str:
    names = BRONZE[entity].names[start:stop]
    return ", ".join(f"{score(i)} AS {q(n)}" for i, n in enumerate(names))


EV_SHIFT = "(ts - INTERVAL 27 YEAR)"

BRONZE_SQL = {
    "b_clientes": f"""
SELECT CAST(o_custkey AS VARCHAR) AS CD_CLIENTE, c_name AS CIDADE, p_type AS DS_CNAE,
  c_mktsegment AS DS_SEGMENTO, nullif(p_type, 'PROMO') AS DS_SUBSEGMENTO,
  p_name || ' #' || CAST(p_partkey AS VARCHAR) AS DS_PROD, p_brand AS DS_LIN_REC,
  o_orderpriority AS FAT_FAIXA, nullif(l_linestatus, 'O') AS MARCA_TOTVS,
  nullif(l_returnflag, 'N') AS MODAL_COMERC, o_orderstatus AS SITUACAO_CONTRATO, n_name AS UF,
  CASE WHEN l_linenumber = 7 THEN {thousands(cents('o_totalprice'))}
       ELSE {money(cents('o_totalprice'))} END AS VL_TOTAL_CONTRATO,
  {dtext('o_orderdate')} AS DT_ASSINATURA_CONTRATO
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "b_historico": f"""
SELECT CAST(l_orderkey AS VARCHAR) AS NR_PROPOSTA, CAST(l_linenumber AS VARCHAR) AS ITEM_PROPOSTA,
  CASE WHEN l_orderkey % 211 = 0 THEN {dtext('l_shipdate')} || ' 00:00:00'
       ELSE {dtext('l_shipdate')} END AS DT_UPLOAD,
  nullif(l_linestatus, 'O') AS HOSPEDAGEM, stray || CAST(o_custkey AS VARCHAR) AS CD_CLI,
  o_orderpriority AS FAT_FAIXA, stray || CAST(l_partkey AS VARCHAR) AS CD_PROD,
  {money(cents('l_quantity'))} AS QTD, CAST(l_linenumber % 4 AS VARCHAR) AS MESES_BONIF,
  {money(cents('l_extendedprice') + ' - ' + cents('l_extendedprice * l_discount'))} AS VL_TOTAL,
  {money(cents('l_extendedprice'))} AS VL_FULL,
  CASE WHEN l_orderkey % 101 = 0 THEN 'n/d'
       ELSE {money(cents('l_extendedprice * l_discount'))} END AS VL_DESCONTO
FROM (SELECT *, '' AS stray FROM lineitem UNION ALL
      SELECT *, 'X' FROM lineitem WHERE l_orderkey % 97 = 0 AND l_linenumber = 1)
  JOIN orders ON l_orderkey = o_orderkey""",
    "b_tickets": f"""
SELECT CASE WHEN l_orderkey % 89 = 0 THEN 'X' ELSE '' END || CAST(o_custkey AS VARCHAR) AS CODIGO_ORGANIZACAO,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE p_name || ' #' || CAST(p_partkey AS VARCHAR) END AS NOME_GRUPO,
  l_returnflag AS TIPO_TICKET, o_orderstatus AS STATUS_TICKET, o_orderpriority AS PRIORIDADE_TICKET,
  CAST(CASE WHEN l_orderkey % 83 = 0 THEN l_orderkey + 9007199254740993 ELSE l_orderkey END AS VARCHAR)
    AS BK_TICKET, {dtext('o_orderdate')} AS DT_CRIACAO,
  CASE WHEN l_orderkey % 79 = 0 THEN {dtext("(l_shipdate + INTERVAL 40 YEAR)")}
       ELSE {dtext('l_shipdate')} END AS DT_ATUALIZACAO
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "b_contratacoes": f"""
SELECT CAST(o_custkey AS VARCHAR) AS CD_CLIENTE, CAST(count(*) AS VARCHAR) AS QTD_CONTRATACOES_12M,
  {money('sum(' + cents('o_totalprice') + ')')} AS VLR_CONTRATACOES_12M
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-08-01' GROUP BY o_custkey""",
    "b_nps_relacional": f"""
SELECT strftime({EV_SHIFT}, '%Y-%m-%d %H:%M:%S') AS respondedAt,
  CAST(user_id AS VARCHAR) AS metadata_codcliente, {NOTA} AS resposta_NPS,
  {_scores('nps_relacional', 3)}
FROM events WHERE event_type = 'view'""",
    "b_nps_produto": f"""
SELECT CASE WHEN event_id % 97 = 0 THEN 'bad'
            WHEN event_id % 3 = 0 THEN strftime({EV_SHIFT}, '%-m/%-d/%Y %-H:%M:%S %p')
            ELSE strftime({EV_SHIFT}, '%-m/%-d/%Y %-I:%M:%S %p') END AS {q('Data da Resposta')},
  coalesce(p_brand, 'Sem Linha') AS {q('Linha de Produto')},
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE p_name || ' #' || CAST(p_partkey AS VARCHAR) END
    AS {q('Nome do Produto')},
  {NOTA} AS Nota, CAST(user_id AS VARCHAR) AS {q('Cod Cliente')}
FROM events LEFT JOIN part ON event_id % (SELECT count(*) FROM part) = p_partkey WHERE event_type = 'purchase'""",
    "b_nps_aquisicao": f"""
SELECT CAST(user_id AS VARCHAR) AS {q('Cod Cliente')},
  strftime({EV_SHIFT}, '%Y-%m-%d') AS {q('Data da Resposta')}, {NOTA} AS {q('Nota NPS')},
  {_scores('nps_transacional_aquisicao', 3)}
FROM events WHERE event_type = 'signup'""",
    "b_nps_onboarding": f"""
SELECT strftime({EV_SHIFT}, '%Y-%m-%dT%H:%M:%S') AS {q('Data de resposta')},
  CAST(user_id AS VARCHAR) AS {q('Cod Cliente')}, {NOTA} AS {q('Nota NPS onboarding')},
  {_scores('nps_transacional_onboarding', 3)}
FROM events WHERE event_type = 'click'""",
    "b_nps_suporte": f"""
SELECT CAST(event_id AS VARCHAR) AS ticket, {NOTA} AS resposta_NPS,
  CASE WHEN event_id % 11 >= 9 THEN 'Promotor' WHEN event_id % 11 >= 7 THEN 'Neutro'
       ELSE 'Detrator' END AS grupo_NPS,
  {_scores('nps_transacional_suporte', 3, 8)}, CAST(user_id AS VARCHAR) AS cliente
FROM events WHERE event_type = 'error'""",
    "b_telemetria": f"""
SELECT CAST(user_id AS VARCHAR) AS clienteid, {money(cents('value'), '.')} AS eventduration,
  json_extract_string(props, '$.k') AS moduloid, CAST(event_id % 7 AS VARCHAR) AS productlineid,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS referencedatestart, event_type AS statuslicenca
FROM events""",
}


def dcomma(c: str) -> str:
    return f"TRY_CAST(replace({c}, ',', '.') AS DOUBLE)"


def to_int(c: str) -> str:
    return f"TRY_CAST(TRY_CAST({c} AS DOUBLE) AS INTEGER)"


def to_long(c: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN TRY_CAST({c} AS BIGINT) "
            f"ELSE TRY_CAST(trunc(TRY_CAST({c} AS DECIMAL(38, 9))) AS BIGINT) END")


def iso_date(c: str) -> str:
    return f"CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"


def any_date(c: str) -> str:
    return f"CAST(TRY_CAST({c} AS TIMESTAMP) AS DATE)"


def us_date(c: str) -> str:
    return (f"CAST(coalesce(try_strptime({c}, '%m/%d/%Y %I:%M:%S %p'), "
            f"try_strptime(regexp_replace({c}, ' (AM|PM)$', ''), '%m/%d/%Y %H:%M:%S')) AS DATE)")


def subs(mapping: dict[str, str]) -> str:
    return ", ".join(f"coalesce(TRY_CAST({q(src)} AS DOUBLE), -1.0) AS {dst}"
                     for dst, src in mapping.items())


def _score_sources(extract: str) -> dict[str, str]:
    """silver sub-score -> source header, from the fixed tables."""
    return {dst: src for src, dst in RENAMES[extract] if dst in FILL_SCORE[extract]}


REL_SUBS = _score_sources("nps_relacional")
ACQ_SUBS = _score_sources("nps_transacional_aquisicao")
ONB_SUBS = _score_sources("nps_transacional_onboarding")
SUP_SUBS = _score_sources("nps_transacional_suporte")

SILVER_SQL = {
    "s_clientes_raw": f"""
SELECT CD_CLIENTE AS cd_cliente, {iso_date('DT_ASSINATURA_CONTRATO')} AS dt_assinatura_contrato,
  {dcomma('VL_TOTAL_CONTRATO')} AS vl_total_contrato, CIDADE AS cidade, DS_CNAE AS ds_cnae,
  DS_SEGMENTO AS ds_segmento, coalesce(DS_SUBSEGMENTO, 'Nao Informado') AS ds_subsegmento,
  DS_PROD AS ds_prod, DS_LIN_REC AS ds_lin_rec, FAT_FAIXA AS fat_faixa,
  coalesce(MARCA_TOTVS, 'Nao Informado') AS marca_totvs,
  coalesce(MODAL_COMERC, 'Nao Informado') AS modal_comerc, UF AS uf,
  SITUACAO_CONTRATO AS situacao_contrato
FROM b_clientes""",
    "s_clientes": """
SELECT r.*, s.dt_inicio_contrato, s.dt_ultimo_contrato FROM s_clientes_raw r
LEFT JOIN (SELECT cd_cliente, min(dt_assinatura_contrato) AS dt_inicio_contrato,
                  max(dt_assinatura_contrato) AS dt_ultimo_contrato
           FROM s_clientes_raw GROUP BY cd_cliente) s ON r.cd_cliente = s.cd_cliente""",
    "s_contratacoes": f"""
SELECT CD_CLIENTE AS cd_cliente, {to_int('QTD_CONTRATACOES_12M')} AS qtd_contratacoes_12m,
  {dcomma('VLR_CONTRATACOES_12M')} AS vlr_contratacoes_12m FROM b_contratacoes""",
    "s_historico": f"""
SELECT NR_PROPOSTA AS nr_proposta, {to_int('ITEM_PROPOSTA')} AS item_proposta,
  {iso_date('DT_UPLOAD')} AS dt_upload, coalesce(HOSPEDAGEM, 'Nao Informado') AS hospedagem,
  CD_CLI AS cd_cliente, FAT_FAIXA AS fat_faixa, CD_PROD AS cd_prod, {dcomma('QTD')} AS qtd,
  {to_int('MESES_BONIF')} AS meses_bonif, {dcomma('VL_TOTAL')} AS vl_total,
  {dcomma('VL_FULL')} AS vl_full, {dcomma('VL_DESCONTO')} AS vl_desconto
FROM b_historico""",
    "s_tickets": f"""
SELECT CODIGO_ORGANIZACAO AS cd_cliente, coalesce(NOME_GRUPO, 'Nao Informado') AS nome_grupo,
  TIPO_TICKET AS tipo_ticket, STATUS_TICKET AS status_ticket,
  PRIORIDADE_TICKET AS prioridade_ticket, {to_long('BK_TICKET')} AS bk_ticket,
  {iso_date('DT_CRIACAO')} AS dt_criacao, {iso_date('DT_ATUALIZACAO')} AS dt_atualizacao,
  CAST(date_diff('day', {iso_date('DT_CRIACAO')}, {iso_date('DT_ATUALIZACAO')}) AS INTEGER)
    AS tempo_resolucao_dias
FROM b_tickets""",
    "s_telemetria": f"""
SELECT clienteid AS cd_cliente, TRY_CAST(eventduration AS DOUBLE) AS duracao_evento,
  moduloid AS id_modulo, productlineid AS id_linha_produto,
  {any_date('referencedatestart')} AS dt_referencia, statuslicenca AS status_licenca
FROM b_telemetria""",
    "s_nps_relacional": f"""
SELECT {any_date('respondedAt')} AS dt_resposta, metadata_codcliente AS cd_cliente,
  {to_int('resposta_NPS')} AS nota_nps, {subs(REL_SUBS)}, 'relacional' AS tipo_nps
FROM b_nps_relacional""",
    "s_nps_produto": f"""
SELECT {us_date(q('Data da Resposta'))} AS dt_resposta, {q('Linha de Produto')} AS linha_produto,
  coalesce({q('Nome do Produto')}, 'Nao Informado') AS nome_produto,
  {to_int('Nota')} AS nota_nps, {q('Cod Cliente')} AS cd_cliente, 'produto' AS tipo_nps
FROM b_nps_produto""",
    "s_nps_aquisicao": f"""
SELECT {q('Cod Cliente')} AS cd_cliente, {iso_date(q('Data da Resposta'))} AS dt_resposta,
  {to_int(q('Nota NPS'))} AS nota_nps, {subs(ACQ_SUBS)}, 'aquisicao' AS tipo_nps
FROM b_nps_aquisicao""",
    "s_nps_onboarding": f"""
SELECT CAST(try_strptime({q('Data de resposta')}, '%Y-%m-%dT%H:%M:%S') AS DATE) AS dt_resposta,
  {q('Cod Cliente')} AS cd_cliente, {to_int(q('Nota NPS onboarding'))} AS nota_nps,
  {subs(ONB_SUBS)}, 'onboarding' AS tipo_nps
FROM b_nps_onboarding""",
    "s_nps_suporte": f"""
SELECT {to_long('ticket')} AS bk_ticket, {to_int('resposta_NPS')} AS nota_nps,
  grupo_NPS AS grupo_nps, {subs(SUP_SUBS)}, cliente AS cd_cliente, 'suporte' AS tipo_nps
FROM b_nps_suporte""",
}


def order_by(cols: list[str]) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def keyed(name: str, cols: list[str], src: str, order_first: list[str] | None = None,
          typ: str = "BIGINT") -> str:
    first = list(order_first or [])
    order = first + [c for c in cols if c not in first]
    return (f"SELECT CAST(row_number() OVER (ORDER BY {order_by(order)}) AS {typ}) AS {name}, "
            f"{', '.join(cols)} FROM {src}")


DIM_CLIENT_COLS = GOLD_COLUMNS["dim_cliente"][1:]
CONTRACT_COLS = GOLD_COLUMNS["fato_contratacoes"][1:]
TICKET_COLS = GOLD_COLUMNS["fato_tickets"][1:]
NPS_COLS = GOLD_COLUMNS["fato_nps"][1:]

GOLD_SQL = {
    "g_dim_time": """
SELECT CAST(year(DATA) * 10000 + month(DATA) * 100 + day(DATA) AS INTEGER) AS SK_TEMPO, DATA,
  CAST(year(DATA) AS INTEGER) AS ANO, CAST(month(DATA) AS INTEGER) AS MES,
  strftime(DATA, '%B') AS NOME_MES, 'Q' || CAST(quarter(DATA) AS VARCHAR) AS TRIMESTRE
FROM (SELECT dt_ultimo_contrato AS DATA FROM s_clientes UNION SELECT dt_criacao FROM s_tickets
      UNION SELECT dt_upload FROM s_historico) d
WHERE DATA IS NOT NULL""",
    "g_dim_client_src": """
SELECT cd_cliente AS CD_CLIENTE, ds_segmento AS DS_SEGMENTO, ds_subsegmento AS DS_SUBSEGMENTO,
  ds_prod AS DS_PROD, fat_faixa AS FAT_FAIXA, uf AS UF, cidade AS CIDADE,
  marca_totvs AS MARCA_TOTVS, situacao_contrato AS SITUACAO_CONTRATO,
  dt_ultimo_contrato AS DT_ULTIMO_CONTRATO, dt_inicio_contrato AS DT_INICIO_CONTRATO,
  dt_assinatura_contrato AS DT_ASSINATURA_CONTRATO
FROM s_clientes""",
    "g_client_rows": keyed("SK_CLIENTE", DIM_CLIENT_COLS + ["DT_ASSINATURA_CONTRATO"],
                           "g_dim_client_src", ["CD_CLIENTE"]),
    "g_dim_client": f"SELECT SK_CLIENTE, {', '.join(DIM_CLIENT_COLS)} FROM g_client_rows",
    "g_client_keys": """
SELECT CD_CLIENTE, SK_CLIENTE FROM (
  SELECT *, row_number() OVER (PARTITION BY CD_CLIENTE ORDER BY DT_ASSINATURA_CONTRATO DESC NULLS LAST,
                                                          SK_CLIENTE) AS rn
  FROM g_client_rows) WHERE rn = 1""",
    "g_codes": """
SELECT DISTINCT cd_cliente, cd_prod AS CD_PRODUTO FROM s_historico
WHERE cd_cliente IS NOT NULL AND cd_prod IS NOT NULL""",
    "g_descs": """
SELECT DISTINCT cd_cliente, ds_prod AS DS_PRODUTO, ds_lin_rec AS DS_LINHA_RECEITA FROM s_clientes
WHERE cd_cliente IS NOT NULL""",
    "g_overlaps": """
SELECT CD_PRODUTO, DS_PRODUTO, DS_LINHA_RECEITA, count(*) AS n FROM g_codes JOIN g_descs USING (cd_cliente)
GROUP BY CD_PRODUTO, DS_PRODUTO, DS_LINHA_RECEITA""",
    "g_product_map": """
SELECT CD_PRODUTO, DS_PRODUTO, DS_LINHA_RECEITA FROM (
  SELECT *, row_number() OVER (PARTITION BY CD_PRODUTO ORDER BY n DESC, DS_PRODUTO NULLS FIRST,
                                                            DS_LINHA_RECEITA NULLS FIRST) AS rn
  FROM g_overlaps) WHERE rn = 1""",
    "g_dim_product": keyed("SK_PRODUTO", ["CD_PRODUTO", "DS_PRODUTO", "DS_LINHA_RECEITA"],
                           "g_product_map", ["CD_PRODUTO"], "INTEGER"),
    "g_products_by_name": """
SELECT DS_PRODUTO, CD_PRODUTO, SK_PRODUTO FROM (
  SELECT *, row_number() OVER (PARTITION BY DS_PRODUTO ORDER BY CD_PRODUTO NULLS FIRST,
                                                          SK_PRODUTO NULLS FIRST) AS rn
  FROM g_dim_product) WHERE rn = 1""",
    "g_dim_priority": keyed("SK_PRIORIDADE", ["TIPO_PRIORIDADE"],
                            "(SELECT DISTINCT prioridade_ticket AS TIPO_PRIORIDADE FROM s_tickets)",
                            None, "INTEGER"),
    "g_dim_ticket": keyed("sk_ticket", ["tipo_ticket", "status_ticket"],
                          "(SELECT DISTINCT tipo_ticket, status_ticket FROM s_tickets)",
                          None, "INTEGER"),
    "g_contracts_base": """
SELECT k.SK_CLIENTE, p.SK_PRODUTO, t.SK_TEMPO, h.vl_total AS VL_TOTAL_CONTRATO,
  h.vl_desconto AS VL_DESCONTO, coalesce(m.vlr_contratacoes_12m, 0) AS VL_CONTRATACOES_12M
FROM s_historico h JOIN g_client_keys k ON h.cd_cliente = k.CD_CLIENTE
LEFT JOIN s_contratacoes m ON h.cd_cliente = m.cd_cliente
JOIN g_dim_product p ON h.cd_prod = p.CD_PRODUTO
JOIN g_dim_time t ON h.dt_upload = t.DATA""",
    "g_fact_contracts": keyed("SK_CONTRATACAO", CONTRACT_COLS, "g_contracts_base"),
    "g_tickets_base": """
SELECT k.SK_CLIENTE, c.SK_TEMPO AS SK_TEMPO, p.SK_PRIORIDADE, d.sk_ticket AS SK_TICKET,
  t.tempo_resolucao_dias AS TEMPO_RESOLUCAO_DIAS
FROM s_tickets t JOIN g_client_keys k ON t.cd_cliente = k.CD_CLIENTE
JOIN g_dim_priority p ON t.prioridade_ticket = p.TIPO_PRIORIDADE
JOIN g_dim_ticket d ON t.tipo_ticket = d.tipo_ticket AND t.status_ticket = d.status_ticket
JOIN g_dim_time c ON t.dt_criacao = c.DATA
WHERE t.dt_atualizacao IN (SELECT DATA FROM g_dim_time)""",
    "g_fact_tickets": keyed("SK_FATO_TICKET", TICKET_COLS, "g_tickets_base"),
    "g_ticket_dates": """
SELECT bk_ticket, min(dt_criacao) AS dt_resposta FROM s_tickets GROUP BY bk_ticket""",
    "g_support_enriched": """
SELECT s.*, d.dt_resposta FROM s_nps_suporte s JOIN g_ticket_dates d ON s.bk_ticket = d.bk_ticket""",
    "g_product_enriched": """
SELECT s.*, p.CD_PRODUTO FROM s_nps_produto s JOIN g_products_by_name p
ON s.nome_produto = p.DS_PRODUTO""",
    "g_surveys": """
SELECT cd_cliente, dt_resposta, nota_nps AS ds_nota, tipo_nps, CAST(NULL AS VARCHAR) AS cd_prod
FROM s_nps_aquisicao
UNION ALL SELECT cd_cliente, dt_resposta, nota_nps, tipo_nps, NULL FROM s_nps_onboarding
UNION ALL SELECT cd_cliente, dt_resposta, nota_nps, tipo_nps, CD_PRODUTO FROM g_product_enriched
UNION ALL SELECT cd_cliente, dt_resposta, nota_nps, tipo_nps, NULL FROM s_nps_relacional
UNION ALL SELECT cd_cliente, dt_resposta, nota_nps, tipo_nps, NULL FROM g_support_enriched""",
    "g_nps_base": """
SELECT k.SK_CLIENTE, t.SK_TEMPO, s.ds_nota AS NOTA_NPS, s.tipo_nps AS TIPO_NPS
FROM g_surveys s JOIN g_client_keys k ON s.cd_cliente = k.CD_CLIENTE
JOIN g_dim_time t ON s.dt_resposta = t.DATA""",
    "g_fact_nps": keyed("SK_FATO_NPS", NPS_COLS, "g_nps_base"),
}

_ALL = {**BRONZE_SQL, **SILVER_SQL, **GOLD_SQL}
PREFIX = "WITH " + ",\n".join(f"{k} AS ({v}\n)" for k, v in _ALL.items()) + "\n"


def sql(body: str) -> str:
    """A full statement: the shared layer definitions plus ``body``."""
    return PREFIX + body.strip()


def select_all(cte: str, cols: list[str] | None = None) -> str:
    return sql(f"SELECT {', '.join(cols) if cols else '*'} FROM {cte}")


def silver_cols(entity: str) -> list[str]:
    return SILVER[entity].names


def number(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def iso_t_date(c: str) -> str:
    return f"CAST(try_strptime({c}, '%Y-%m-%dT%H:%M:%S') AS DATE)"


# fixed values: the parsed columns of every extract, with their source headers
AUDITED = {
    "dados_clientes": ("b_clientes", [("vl_total_contrato", "VL_TOTAL_CONTRATO", dcomma),
                                      ("dt_assinatura_contrato", "DT_ASSINATURA_CONTRATO", iso_date)]),
    "contratacoes_ultimos_12_meses": ("b_contratacoes", [
        ("qtd_contratacoes_12m", "QTD_CONTRATACOES_12M", to_int),
        ("vlr_contratacoes_12m", "VLR_CONTRATACOES_12M", dcomma)]),
    "historico": ("b_historico", [
        ("item_proposta", "ITEM_PROPOSTA", to_int), ("dt_upload", "DT_UPLOAD", iso_date), ("qtd", "QTD", dcomma),
        ("meses_bonif", "MESES_BONIF", to_int), ("vl_total", "VL_TOTAL", dcomma), ("vl_full", "VL_FULL", dcomma),
        ("vl_desconto", "VL_DESCONTO", dcomma)]),
    "tickets": ("b_tickets", [("bk_ticket", "BK_TICKET", to_long), ("dt_criacao", "DT_CRIACAO", iso_date),
                              ("dt_atualizacao", "DT_ATUALIZACAO", iso_date)]),
    "telemetria": ("b_telemetria", [("duracao_evento", "eventduration", number),
                                    ("dt_referencia", "referencedatestart", any_date)]),
    "nps_relacional": ("b_nps_relacional", [
        ("dt_resposta", "respondedAt", any_date), ("nota_nps", "resposta_NPS", to_int),
        ("nota_unidade", "resposta_unidade", number), ("nota_suporte_agilidade", "Nota_SupTec_Agilidade", number),
        ("nota_suporte_atendimento", "Nota_SupTec_Atendimento", number), ("nota_comercial", "Nota_Comercial", number),
        ("nota_custos", "Nota_Custos", number), ("nota_admfin_atendimento", "Nota_AdmFin_Atendimento", number),
        ("nota_software", "Nota_Software", number),
        ("nota_software_atualizacao", "Nota_Software_Atualizacao", number)]),
    "nps_transacional_produto": ("b_nps_produto", [("dt_resposta", "Data da Resposta", us_date),
                                                   ("nota_nps", "Nota", to_int)]),
    "nps_transacional_aquisicao": ("b_nps_aquisicao", [
        ("dt_resposta", "Data da Resposta", iso_date), ("nota_nps", "Nota NPS", to_int),
        ("nota_agilidade", "Nota Agilidade", number), ("nota_conhecimento", "Nota Conhecimento", number),
        ("nota_custo", "Nota Custo", number), ("nota_facilidade", "Nota Facilidade", number),
        ("nota_flexibilidade", "Nota Flexibilidade", number)]),
    "nps_transacional_onboarding": ("b_nps_onboarding", [
        ("dt_resposta", "Data de resposta", iso_t_date), ("nota_nps", "Nota NPS onboarding", to_int),
        ("nota_atendimento_cs", "Nota atendimento CS", number),
        ("nota_duracao_reuniao", "Nota duracao reuniao", number),
        ("nota_clareza_acesso", "Nota clareza acesso", number),
        ("nota_clareza_informacoes", "Nota clareza informacoes", number),
        ("nota_expectativas", "Nota expectativas", number)]),
    "nps_transacional_suporte": ("b_nps_suporte", [
        ("bk_ticket", "ticket", to_long), ("nota_nps", "resposta_NPS", to_int),
        ("nota_conhecimento_agente", "Nota_ConhecimentoAgente", number), ("nota_solucao", "Nota_Solucao", number),
        ("nota_tempo_retorno", "Nota_TempoRetorno", number), ("nota_facilidade", "Nota_Facilidade", number),
        ("nota_satisfacao", "Nota_Satisfacao", number)]),
}
PARSE_FAILURES = sql(" UNION ALL ".join(
    f"SELECT '{extract}' AS extract, '{dst}' AS column_name, "
    f"count(*) FILTER (WHERE trim({q(src)}) <> '' AND {parse(q(src))} IS NULL) AS n_failed FROM {cte}"
    for extract, (cte, columns) in AUDITED.items() for dst, src, parse in columns))
