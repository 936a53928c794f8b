"""Fixed schemas for every entity of the three layers.

Bronze files are read as text with a fixed schema (no inference pass, no
type drift between extracts: the business key is always a string); the
silver layer parses the text with ANSI-safe expressions; gold tables have
a fixed column order.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# fixed values: bronze extracts (all read as text) with their source
# header names, in the extracts' column order
BRONZE = {
    "dados_clientes": _text(
        "CD_CLIENTE", "CIDADE", "DS_CNAE", "DS_SEGMENTO", "DS_SUBSEGMENTO",
        "DS_PROD", "DS_LIN_REC", "FAT_FAIXA", "MARCA_TOTVS", "MODAL_COMERC",
        "SITUACAO_CONTRATO", "UF", "VL_TOTAL_CONTRATO", "DT_ASSINATURA_CONTRATO"),
    "contratacoes_ultimos_12_meses": _text(
        "CD_CLIENTE", "QTD_CONTRATACOES_12M", "VLR_CONTRATACOES_12M"),
    "historico": _text(
        "NR_PROPOSTA", "ITEM_PROPOSTA", "DT_UPLOAD", "HOSPEDAGEM", "CD_CLI",
        "FAT_FAIXA", "CD_PROD", "QTD", "MESES_BONIF", "VL_TOTAL", "VL_FULL",
        "VL_DESCONTO"),
    "tickets": _text(
        "CODIGO_ORGANIZACAO", "NOME_GRUPO", "TIPO_TICKET", "STATUS_TICKET",
        "PRIORIDADE_TICKET", "BK_TICKET", "DT_CRIACAO", "DT_ATUALIZACAO"),
    "telemetria": _text(
        "clienteid", "eventduration", "moduloid", "productlineid",
        "referencedatestart", "statuslicenca"),
    "nps_relacional": _text(
        "respondedAt", "metadata_codcliente", "resposta_NPS", "resposta_unidade",
        "Nota_SupTec_Agilidade", "Nota_SupTec_Atendimento", "Nota_Comercial",
        "Nota_Custos", "Nota_AdmFin_Atendimento", "Nota_Software",
        "Nota_Software_Atualizacao"),
    "nps_transacional_produto": _text(
        "Data da Resposta", "Linha de Produto", "Nome do Produto", "Nota",
        "Cod Cliente"),
    "nps_transacional_aquisicao": _text(
        "Cod Cliente", "Data da Resposta", "Nota NPS", "Nota Agilidade",
        "Nota Conhecimento", "Nota Custo", "Nota Facilidade",
        "Nota Flexibilidade"),
    "nps_transacional_onboarding": _text(
        "Data de resposta", "Cod Cliente", "Nota NPS onboarding",
        "Nota atendimento CS", "Nota duracao reuniao", "Nota clareza acesso",
        "Nota clareza informacoes", "Nota expectativas"),
    "nps_transacional_suporte": _text(
        "ticket", "resposta_NPS", "grupo_NPS", "Nota_ConhecimentoAgente",
        "Nota_Solucao", "Nota_TempoRetorno", "Nota_Facilidade",
        "Nota_Satisfacao", "cliente"),
}

# fixed values: file name (or glob) and separator of each bronze extract
BRONZE_FILES = {
    "dados_clientes": ("dados_clientes.csv", ";"),
    "contratacoes_ultimos_12_meses": ("contratacoes_ultimos_12_meses.csv", ";"),
    "historico": ("historico.csv", ";"),
    "tickets": ("tickets.csv", ";"),
    "telemetria": ("telemetria_*", ","),
    "nps_relacional": ("nps_relacional.csv", ";"),
    "nps_transacional_produto": ("nps_transacional_produto.csv", ";"),
    "nps_transacional_aquisicao": ("nps_transacional_aquisicao.csv", ";"),
    "nps_transacional_onboarding": ("nps_transacional_onboarding.csv", ";"),
    "nps_transacional_suporte": ("nps_transacional_suporte.csv", ";"),
}


_TYPES = {"string": T.StringType(), "date": T.DateType(), "double": T.DoubleType(),
          "int": T.IntegerType(), "bigint": T.LongType(), "timestamp": T.TimestampType()}


def _schema(spec: str) -> T.StructType:
    """``"a string, b int"`` -> StructType (usable before a session exists)."""
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, _TYPES[typ], True))
    return T.StructType(fields)


# -- silver: typed, snake_case --
SILVER = {
    "clientes": _schema(
        "cd_cliente string, dt_assinatura_contrato date, vl_total_contrato double, "
        "cidade string, ds_cnae string, ds_segmento string, ds_subsegmento string, "
        "ds_prod string, ds_lin_rec string, fat_faixa string, marca_totvs string, "
        "modal_comerc string, uf string, situacao_contrato string, "
        "dt_inicio_contrato date, dt_ultimo_contrato date"),
    "contratacoes": _schema(
        "cd_cliente string, qtd_contratacoes_12m int, vlr_contratacoes_12m double"),
    "historico": _schema(
        "nr_proposta string, item_proposta int, dt_upload date, hospedagem string, "
        "cd_cliente string, fat_faixa string, cd_prod string, qtd double, "
        "meses_bonif int, vl_total double, vl_full double, vl_desconto double"),
    "tickets": _schema(
        "cd_cliente string, nome_grupo string, tipo_ticket string, status_ticket string, "
        "prioridade_ticket string, bk_ticket bigint, dt_criacao date, "
        "dt_atualizacao date, tempo_resolucao_dias int"),
    "telemetria": _schema(
        "cd_cliente string, duracao_evento double, id_modulo string, "
        "id_linha_produto string, dt_referencia date, status_licenca string"),
    "nps_relacional": _schema(
        "dt_resposta date, cd_cliente string, nota_nps int, nota_unidade double, "
        "nota_suporte_agilidade double, nota_suporte_atendimento double, "
        "nota_comercial double, nota_custos double, nota_admfin_atendimento double, "
        "nota_software double, nota_software_atualizacao double, tipo_nps string"),
    "nps_transacional_produto": _schema(
        "dt_resposta date, linha_produto string, nome_produto string, nota_nps int, "
        "cd_cliente string, tipo_nps string"),
    "nps_transacional_aquisicao": _schema(
        "cd_cliente string, dt_resposta date, nota_nps int, nota_agilidade double, "
        "nota_conhecimento double, nota_custo double, nota_facilidade double, "
        "nota_flexibilidade double, tipo_nps string"),
    "nps_transacional_onboarding": _schema(
        "dt_resposta date, cd_cliente string, nota_nps int, nota_atendimento_cs double, "
        "nota_duracao_reuniao double, nota_clareza_acesso double, "
        "nota_clareza_informacoes double, nota_expectativas double, tipo_nps string"),
    "nps_transacional_suporte": _schema(
        "bk_ticket bigint, nota_nps int, grupo_nps string, "
        "nota_conhecimento_agente double, nota_solucao double, "
        "nota_tempo_retorno double, nota_facilidade double, nota_satisfacao double, "
        "cd_cliente string, tipo_nps string"),
}

# fixed values: gold column names, in the order of each dimension and fact
GOLD_COLUMNS = {
    "dim_cliente": ["SK_CLIENTE", "CD_CLIENTE", "DS_SEGMENTO", "DS_SUBSEGMENTO",
                    "DS_PROD", "FAT_FAIXA", "UF", "CIDADE", "MARCA_TOTVS",
                    "SITUACAO_CONTRATO", "DT_ULTIMO_CONTRATO", "DT_INICIO_CONTRATO"],
    "dim_produto": ["SK_PRODUTO", "CD_PRODUTO", "DS_PRODUTO", "DS_LINHA_RECEITA"],
    "dim_tempo": ["SK_TEMPO", "DATA", "ANO", "MES", "NOME_MES", "TRIMESTRE"],
    "dim_prioridade": ["SK_PRIORIDADE", "TIPO_PRIORIDADE"],
    "dim_ticket": ["sk_ticket", "tipo_ticket", "status_ticket"],
    "fato_contratacoes": ["SK_CONTRATACAO", "SK_CLIENTE", "SK_PRODUTO", "SK_TEMPO",
                          "VL_TOTAL_CONTRATO", "VL_DESCONTO", "VL_CONTRATACOES_12M"],
    "fato_tickets": ["SK_FATO_TICKET", "SK_CLIENTE", "SK_TEMPO", "SK_PRIORIDADE",
                     "SK_TICKET", "TEMPO_RESOLUCAO_DIAS"],
    "fato_nps": ["SK_FATO_NPS", "SK_CLIENTE", "SK_TEMPO", "NOTA_NPS", "TIPO_NPS"],
}

# fixed values: source header -> silver column of every extract, in the
# extract's column order
RENAMES = {
    "dados_clientes": [
        ("CD_CLIENTE", "cd_cliente"), ("CIDADE", "cidade"), ("DS_CNAE", "ds_cnae"),
        ("DS_SEGMENTO", "ds_segmento"), ("DS_SUBSEGMENTO", "ds_subsegmento"),
        ("DS_PROD", "ds_prod"), ("DS_LIN_REC", "ds_lin_rec"), ("FAT_FAIXA", "fat_faixa"),
        ("MARCA_TOTVS", "marca_totvs"), ("MODAL_COMERC", "modal_comerc"),
        ("SITUACAO_CONTRATO", "situacao_contrato"), ("UF", "uf"),
        ("VL_TOTAL_CONTRATO", "vl_total_contrato"),
        ("DT_ASSINATURA_CONTRATO", "dt_assinatura_contrato")],
    "contratacoes_ultimos_12_meses": [
        ("CD_CLIENTE", "cd_cliente"), ("QTD_CONTRATACOES_12M", "qtd_contratacoes_12m"),
        ("VLR_CONTRATACOES_12M", "vlr_contratacoes_12m")],
    "historico": [
        ("NR_PROPOSTA", "nr_proposta"), ("ITEM_PROPOSTA", "item_proposta"),
        ("DT_UPLOAD", "dt_upload"), ("HOSPEDAGEM", "hospedagem"), ("CD_CLI", "cd_cliente"),
        ("FAT_FAIXA", "fat_faixa"), ("CD_PROD", "cd_prod"), ("QTD", "qtd"),
        ("MESES_BONIF", "meses_bonif"), ("VL_TOTAL", "vl_total"), ("VL_FULL", "vl_full"),
        ("VL_DESCONTO", "vl_desconto")],
    "tickets": [
        ("CODIGO_ORGANIZACAO", "cd_cliente"), ("NOME_GRUPO", "nome_grupo"),
        ("TIPO_TICKET", "tipo_ticket"), ("STATUS_TICKET", "status_ticket"),
        ("PRIORIDADE_TICKET", "prioridade_ticket"), ("BK_TICKET", "bk_ticket"),
        ("DT_CRIACAO", "dt_criacao"), ("DT_ATUALIZACAO", "dt_atualizacao")],
    "telemetria": [
        ("clienteid", "cd_cliente"), ("eventduration", "duracao_evento"),
        ("moduloid", "id_modulo"), ("productlineid", "id_linha_produto"),
        ("referencedatestart", "dt_referencia"), ("statuslicenca", "status_licenca")],
    "nps_relacional": [
        ("respondedAt", "dt_resposta"), ("metadata_codcliente", "cd_cliente"),
        ("resposta_NPS", "nota_nps"), ("resposta_unidade", "nota_unidade"),
        ("Nota_SupTec_Agilidade", "nota_suporte_agilidade"),
        ("Nota_SupTec_Atendimento", "nota_suporte_atendimento"),
        ("Nota_Comercial", "nota_comercial"), ("Nota_Custos", "nota_custos"),
        ("Nota_AdmFin_Atendimento", "nota_admfin_atendimento"),
        ("Nota_Software", "nota_software"),
        ("Nota_Software_Atualizacao", "nota_software_atualizacao")],
    "nps_transacional_produto": [
        ("Data da Resposta", "dt_resposta"), ("Linha de Produto", "linha_produto"),
        ("Nome do Produto", "nome_produto"), ("Nota", "nota_nps"),
        ("Cod Cliente", "cd_cliente")],
    "nps_transacional_aquisicao": [
        ("Cod Cliente", "cd_cliente"), ("Data da Resposta", "dt_resposta"),
        ("Nota NPS", "nota_nps"), ("Nota Agilidade", "nota_agilidade"),
        ("Nota Conhecimento", "nota_conhecimento"), ("Nota Custo", "nota_custo"),
        ("Nota Facilidade", "nota_facilidade"), ("Nota Flexibilidade", "nota_flexibilidade")],
    "nps_transacional_onboarding": [
        ("Data de resposta", "dt_resposta"), ("Cod Cliente", "cd_cliente"),
        ("Nota NPS onboarding", "nota_nps"), ("Nota atendimento CS", "nota_atendimento_cs"),
        ("Nota duracao reuniao", "nota_duracao_reuniao"),
        ("Nota clareza acesso", "nota_clareza_acesso"),
        ("Nota clareza informacoes", "nota_clareza_informacoes"),
        ("Nota expectativas", "nota_expectativas")],
    "nps_transacional_suporte": [
        ("ticket", "bk_ticket"), ("resposta_NPS", "nota_nps"), ("grupo_NPS", "grupo_nps"),
        ("Nota_ConhecimentoAgente", "nota_conhecimento_agente"),
        ("Nota_Solucao", "nota_solucao"), ("Nota_TempoRetorno", "nota_tempo_retorno"),
        ("Nota_Facilidade", "nota_facilidade"), ("Nota_Satisfacao", "nota_satisfacao"),
        ("cliente", "cd_cliente")],
}

# fixed values: silver text columns whose missing values get the
# placeholder, and survey sub-scores whose missing values get the sentinel
FILL_TEXT = {
    "dados_clientes": ["ds_subsegmento", "marca_totvs", "modal_comerc"],
    "historico": ["hospedagem"],
    "tickets": ["nome_grupo"],
    "nps_transacional_produto": ["nome_produto"],
}
FILL_SCORE = {
    "nps_relacional": ["nota_unidade", "nota_suporte_agilidade", "nota_suporte_atendimento",
                       "nota_comercial", "nota_custos", "nota_admfin_atendimento",
                       "nota_software", "nota_software_atualizacao"],
    "nps_transacional_aquisicao": ["nota_agilidade", "nota_conhecimento", "nota_custo",
                                   "nota_facilidade", "nota_flexibilidade"],
    "nps_transacional_onboarding": ["nota_atendimento_cs", "nota_duracao_reuniao",
                                    "nota_clareza_acesso", "nota_clareza_informacoes",
                                    "nota_expectativas"],
    "nps_transacional_suporte": ["nota_conhecimento_agente", "nota_solucao",
                                 "nota_tempo_retorno", "nota_facilidade", "nota_satisfacao"],
}

# fixed values: the placeholder the source uses for missing text, and the
# sentinel it uses for a missing survey sub-score
UNKNOWN_TEXT = "Nao Informado"
MISSING_SCORE = -1

# fixed values: survey discriminator tags
NPS_TAGS = {
    "nps_relacional": "relacional",
    "nps_transacional_produto": "produto",
    "nps_transacional_aquisicao": "aquisicao",
    "nps_transacional_onboarding": "onboarding",
    "nps_transacional_suporte": "suporte",
}


def assert_schema(df, expected: T.StructType) -> None:
    """Replace the by-eye ``printSchema`` checks with an assertion on names
    and types (nullability is not compared)."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    if got != want:
        raise AssertionError(f"schema mismatch:\n got  {got}\n want {want}")
