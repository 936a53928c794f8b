"""Registered queries: one per operator / job of the inventory, each a
``(spark, sf_dir) -> DataFrame`` over the whole test tables, paired with
its DuckDB statement (``None`` = rows-only check).

Every callable builds a fresh :class:`Warehouse`, so a query pays for all
of its own inputs (nothing is shared between queries).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge import oracle as O
from starforge.functions import (as_date, calendar_attributes, date_key,
                                 decimal_comma, parse_date, parse_date_us,
                                 parse_ts_date, to_int)
from starforge.functions.parsing import ISO_DATE
from starforge.operators import (ROW_ID, ParseAudit, contract_span, with_row_identity,
                                 cooccurrence_pairs_per_client, dense_key,
                                 distinct_rows, drop_duplicates_all, enrich,
                                 fill_zero, infer_product_map, keep_one, lookup, lookup_split,
                                 observe_rows, observed_dates, rejects, rename_project,
                                 replace_column, require_in, role_join,
                                 surrogate_key, tag, to_gold_names)
from starforge.operators.shaping import col
from starforge.plans import dims, facts
from starforge.plans.silver import (SILVER_JOBS, silver_clients, silver_contracts_12m,
                                    silver_history, silver_nps_acquisition,
                                    silver_nps_onboarding, silver_nps_product,
                                    silver_nps_relational, silver_nps_support,
                                    silver_telemetry, silver_tickets, silver_clients_raw)
from starforge.plans.warehouse import Warehouse
from starforge.schemas import BRONZE, BRONZE_FILES, GOLD_COLUMNS, SILVER
from starforge.plans.pipeline import extend_dim
from starforge.session import scratch_path
from starforge.sinks import feed_sinks, publish, read_version, write_parquet, write_version
from starforge.sources import read_csv, read_csv_variants, read_parquet, write_csv


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    flagship: bool = False


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, oracle)
        return fn
    return deco


def W(spark, sf_dir, *gold: str, **silver: tuple[str, ...]) -> Warehouse:
    """A warehouse that stages what the ``gold`` tables (see ``READS``) and the
    query itself read of each silver table; every column, if neither is named."""
    reads = {}
    for part in [READS[g] for g in gold] + [silver]:
        for entity, columns in part.items():
            known = reads.get(entity, ())
            reads[entity] = None if columns is None or known is None else (*known, *columns)
    return Warehouse(spark, sf_dir, reads=reads)


# the silver columns that a gold table is built from (None: all)
READS = {
    "dim_time": {"clientes": ("cd_cliente", "dt_assinatura_contrato"), "tickets": ("dt_criacao",),
                 "historico": ("dt_upload",)},
    "dim_product": {"clientes": ("cd_cliente", "ds_prod", "ds_lin_rec"), "historico": ("cd_cliente", "cd_prod")},
    "client_map": {"clientes": ("cd_cliente", "dt_assinatura_contrato",
                                *[c.lower() for c in GOLD_COLUMNS["dim_cliente"][1:]])},
    "fact_contracts": {"historico": ("cd_cliente", "cd_prod", "dt_upload", "vl_total", "vl_desconto"),
                       "contratacoes": ("cd_cliente", "vlr_contratacoes_12m")},
    "fact_tickets": {"tickets": ("cd_cliente", "prioridade_ticket", "tipo_ticket", "status_ticket",
                                 "dt_criacao", "dt_atualizacao", "tempo_resolucao_dias")},
    "surveys": {"tickets": ("bk_ticket", "dt_criacao"),
                "nps_transacional_suporte": ("bk_ticket", "cd_cliente", "nota_nps", "tipo_nps"),
                "nps_transacional_produto": ("cd_cliente", "dt_resposta", "nota_nps", "tipo_nps", "nome_produto"),
                **{e: ("cd_cliente", "dt_resposta", "nota_nps", "tipo_nps") for e in (
                    "nps_transacional_aquisicao", "nps_transacional_onboarding", "nps_relacional")}},
}


def _silver_sql(entity: str, cte: str) -> str:
    return O.select_all(cte, SILVER[entity].names)


# ---------------------------------------------------------------- sources
@register("csv_semicolon_scan", O.select_all("b_historico", BRONZE["historico"].names))
def csv_semicolon_scan(spark, sf_dir):
    """Land the proposal extract as ';' text with its columns in another
    order and one more, scan it with the fixed schema."""
    path = scratch_path(spark, "historico_csv")
    src = W(spark, sf_dir).bronze("historico")
    write_csv(src.select(F.lit("x").alias("EXTRA"), *[F.col(f"`{c}`") for c in reversed(src.columns)]),
              path, sep=";")
    return read_csv(spark, path, BRONZE["historico"], sep=";")


@register("csv_glob_scan", O.select_all("b_telemetria", BRONZE["telemetria"].names))
def csv_glob_scan(spark, sf_dir):
    """Several ``telemetria_*`` directories read as one table."""
    root = scratch_path(spark, "telemetry_landing")
    src = W(spark, sf_dir).bronze("telemetria")
    odd = (F.col("productlineid").cast("int") % 2) == 1
    write_csv(src.filter(odd), f"{root}/telemetria_a", sep=",")
    write_csv(src.filter(~odd), f"{root}/telemetria_b", sep=",")
    return read_csv(spark, f"{root}/telemetria_*", BRONZE["telemetria"], sep=",")


@register("csv_drift_scan", O.sql("""
SELECT clienteid, eventduration, moduloid, productlineid,
  CASE WHEN CAST(productlineid AS INTEGER) % 3 = 1 THEN NULL ELSE referencedatestart END AS referencedatestart,
  statuslicenca FROM b_telemetria"""))
def csv_drift_scan(spark, sf_dir):
    """Landings of three headers read as one table: the schema's own; one
    without a column; one in another order, with other names and one column
    more."""
    root = scratch_path(spark, "telemetry_drift")
    src = W(spark, sf_dir).bronze("telemetria")
    part = F.col("productlineid").cast("int") % 3
    write_csv(src.filter(part == 0), f"{root}/telemetria_a", sep=",")
    write_csv(src.filter(part == 1).drop("referencedatestart"), f"{root}/telemetria_b", sep=",")
    moved = src.filter(part == 2).select(F.lit("x").alias("versao"), F.col("clienteid").alias("CLIENTEID"),
                                         F.col("statuslicenca").alias("licenca"), "referencedatestart",
                                         "productlineid", "moduloid", "eventduration")
    write_csv(moved, f"{root}/telemetria_c", sep=",")
    return read_csv_variants(spark, f"{root}/telemetria_*", BRONZE["telemetria"], sep=",",
                             required=["clienteid"], aliases={"licenca": "statuslicenca"})[0]


@register("csv_infer_scan", O.sql("""
SELECT CAST(CD_CLIENTE AS INTEGER) AS CD_CLIENTE,
       CAST(QTD_CONTRATACOES_12M AS INTEGER) AS QTD_CONTRATACOES_12M, VLR_CONTRATACOES_12M
FROM b_contratacoes"""))
def csv_infer_scan(spark, sf_dir):
    """S3: opt-in schema inference (integers are inferred, decimal-comma
    text stays text)."""
    path = scratch_path(spark, "contratacoes_csv")
    write_csv(W(spark, sf_dir).bronze("contratacoes_ultimos_12_meses"), path, sep=";")
    return read_csv(spark, path, None, sep=";", infer=True)


@register("parquet_scan", _silver_sql("tickets", "s_tickets"))
def parquet_scan(spark, sf_dir):
    """A silver table written once and scanned back."""
    path = scratch_path(spark, "silver_tickets")
    write_parquet(W(spark, sf_dir).silver("tickets"), path)
    return read_parquet(spark, path, SILVER["tickets"])


@register("silver_parse_failures", O.PARSE_FAILURES)
def silver_parse_failures(spark, sf_dir):
    """Texts that became NULL, per extract and column, counted by the
    writes of the ten silver tables themselves."""
    wh, rows = W(spark, sf_dir), []
    for entity, (extract, job) in SILVER_JOBS.items():
        audit = ParseAudit()
        job = silver_clients_raw if entity == "clientes" else job
        write_parquet(job(wh.bronze(extract), audit=audit), scratch_path(spark, f"audited_{entity}"))
        rows += [(extract, c, n) for c, n in audit.failures().items()]
    return spark.createDataFrame(rows, "extract string, column_name string, n_failed long")


# ------------------------------------------------------------------ sinks
@register("parquet_overwrite_roundtrip", _silver_sql("clientes", "s_clientes"))
def parquet_overwrite_roundtrip(spark, sf_dir):
    """K1: overwrite twice, the second write replaces the first."""
    path = scratch_path(spark, "silver_clients")
    df = W(spark, sf_dir).silver("clientes")
    write_parquet(df, path, "overwrite")
    write_parquet(df, path, "overwrite")
    return read_parquet(spark, path)


@register("parquet_append_roundtrip", O.sql("""
SELECT * FROM s_contratacoes UNION ALL SELECT * FROM s_contratacoes"""))
def parquet_append_roundtrip(spark, sf_dir):
    """K2: append twice -> every row twice."""
    path = scratch_path(spark, "silver_contracts")
    df = W(spark, sf_dir).silver("contratacoes")
    write_parquet(df, path, "append")
    write_parquet(df, path, "append")
    return read_parquet(spark, path)


@register("dual_publish", O.select_all("g_dim_ticket"))
def dual_publish(spark, sf_dir):
    """K5: publish once to Parquet (row count observed during the write);
    other sinks would be fed from this copy."""
    path = scratch_path(spark, "gold_dim_ticket")
    res = publish(W(spark, sf_dir).dim_ticket(), path)
    if not all(r.ok for r in res):
        raise RuntimeError(res)
    return read_parquet(spark, path)


@register("atomic_overwrite_roundtrip", O.sql("""
SELECT * FROM s_contratacoes UNION ALL SELECT * FROM s_contratacoes"""))
def atomic_overwrite_roundtrip(spark, sf_dir):
    """K1 / K2 as versions: written, overwritten (one version stands), then
    appended to; read back through the committed version."""
    path = scratch_path(spark, "versioned_contracts")
    df = W(spark, sf_dir).silver("contratacoes")
    for mode in ("overwrite", "overwrite", "append"):
        write_version(df, path, mode)
    return read_version(spark, path)


@register("resumed_publish", O.select_all("g_dim_ticket"))
def resumed_publish(spark, sf_dir):
    """K5 / K6: the first copy fails, the rerun feeds only that sink; the
    result is what the sink holds."""
    path, copy = scratch_path(spark, "versioned_dim_ticket"), scratch_path(spark, "copy_dim_ticket")
    calls = []

    def sink(df, mode):
        calls.append(mode)
        if len(calls) == 1:
            raise ConnectionError("the sink is down")
        write_parquet(df, copy, mode)
    write_version(W(spark, sf_dir).dim_ticket(), path)
    runs = [feed_sinks(spark, path, {"copy": sink})[0].ok for _ in range(3)]
    if runs != [False, True, True] or len(calls) != 2:
        raise RuntimeError((runs, calls))
    return read_parquet(spark, copy)


@register("dim_append_keys", O.sql("""
SELECT * FROM (
WITH one AS (SELECT CD_PRODUTO, row_number() OVER (ORDER BY CD_PRODUTO) AS SK_PRODUTO
             FROM (SELECT DISTINCT cd_prod AS CD_PRODUTO FROM s_historico
                   WHERE cd_prod IS NOT NULL AND dt_upload < DATE '1995-03-01')),
two AS (SELECT CD_PRODUTO, row_number() OVER (ORDER BY CD_PRODUTO) + (SELECT max(SK_PRODUTO) FROM one) AS SK_PRODUTO
        FROM (SELECT DISTINCT cd_prod AS CD_PRODUTO FROM s_historico WHERE cd_prod IS NOT NULL)
        WHERE CD_PRODUTO NOT IN (SELECT CD_PRODUTO FROM one))
SELECT SK_PRODUTO, CD_PRODUTO FROM one UNION ALL SELECT SK_PRODUTO, CD_PRODUTO FROM two)"""))
def dim_append_keys(spark, sf_dir):
    """Products of the proposals before March 1995, then of all proposals,
    then of all again, into one dimension: keys stay, only new codes are numbered."""
    path = scratch_path(spark, "dim_products")
    items = W(spark, sf_dir).silver("historico").filter("cd_prod is not null")
    codes = lambda df: df.select(F.col("cd_prod").alias("CD_PRODUTO"))      # noqa: E731
    for run in (items.filter("dt_upload < date '1995-03-01'"), items, items):
        extend_dim(codes(run), path, "SK_PRODUTO", ["CD_PRODUTO"])
    return read_version(spark, path)


# -------------------------------------------------------------- shaping
_HIST_RENAMES = {
    "nr_proposta": "NR_PROPOSTA", "item_proposta": "ITEM_PROPOSTA", "dt_upload": "DT_UPLOAD",
    "hospedagem": "HOSPEDAGEM", "cd_cliente": "CD_CLI", "fat_faixa": "FAT_FAIXA",
    "cd_prod": "CD_PROD", "qtd": "QTD", "meses_bonif": "MESES_BONIF", "vl_total": "VL_TOTAL",
    "vl_full": "VL_FULL", "vl_desconto": "VL_DESCONTO"}


@register("rename_project", O.sql(
    "SELECT " + ", ".join(f"{v} AS {k}" for k, v in _HIST_RENAMES.items()) + " FROM b_historico"))
def q_rename_project(spark, sf_dir):
    """Project + rename to snake_case."""
    return rename_project(W(spark, sf_dir).bronze("historico"), _HIST_RENAMES)


_ACQ_RENAMES = {"cd_cliente": "Cod Cliente", "data_resposta": "Data da Resposta",
                "nota_nps": "Nota NPS", "nota_agilidade": "Nota Agilidade",
                "nota_conhecimento": "Nota Conhecimento", "nota_custo": "Nota Custo",
                "nota_facilidade": "Nota Facilidade", "nota_flexibilidade": "Nota Flexibilidade"}


@register("rename_spaced_columns", O.sql(
    "SELECT " + ", ".join(f'"{v}" AS {k}' for k, v in _ACQ_RENAMES.items())
    + " FROM b_nps_aquisicao"))
def q_rename_spaced(spark, sf_dir):
    """Source headers with spaces."""
    return rename_project(W(spark, sf_dir).bronze("nps_transacional_aquisicao"), _ACQ_RENAMES)


_GOLD_CLIENT = ["CD_CLIENTE", "DS_SEGMENTO", "UF", "SITUACAO_CONTRATO", "DT_INICIO_CONTRATO"]


@register("gold_names_project", O.sql(
    "SELECT " + ", ".join(f"{c.lower()} AS {c}" for c in _GOLD_CLIENT) + " FROM s_clientes"))
def q_gold_names(spark, sf_dir):
    """Case-insensitive resolution with upper-case gold names."""
    return to_gold_names(W(spark, sf_dir).silver("clientes"), _GOLD_CLIENT)


@register("constant_tag", O.sql(
    "SELECT metadata_codcliente AS cd_cliente, 'relacional' AS tipo_nps FROM b_nps_relacional"))
def q_constant_tag(spark, sf_dir):
    """Constant discriminator column."""
    b = W(spark, sf_dir).bronze("nps_relacional")
    return tag(b.select(F.col("metadata_codcliente").alias("cd_cliente")), "tipo_nps", "relacional")


@register("unit_measure", O.sql("""
SELECT prioridade_ticket, CAST(sum(1) AS BIGINT) AS QTD_TICKETS FROM s_tickets
GROUP BY prioridade_ticket"""))
def q_unit_measure(spark, sf_dir):
    """P5: constant counter measure, summed per priority."""
    t = tag(W(spark, sf_dir).silver("tickets"), "QTD_TICKETS", 1)
    return t.groupBy("prioridade_ticket").agg(F.sum("QTD_TICKETS").cast("bigint").alias("QTD_TICKETS"))


@register("replace_column", O.sql("""
SELECT bk_ticket, dt_criacao, dt_atualizacao,
  CAST(date_diff('day', dt_criacao, dt_atualizacao) AS INTEGER) AS tempo_resolucao_dias
FROM s_tickets"""))
def q_replace_column(spark, sf_dir):
    """Replace an existing column (matched case-insensitively)."""
    t = W(spark, sf_dir).silver("tickets")
    t = replace_column(t, "TEMPO_RESOLUCAO_DIAS",
                       F.datediff(as_date("dt_atualizacao"), as_date("dt_criacao")))
    return t.select("bk_ticket", "dt_criacao", "dt_atualizacao", "tempo_resolucao_dias")


# -------------------------------------------------------------- filters
@register("not_null_filter", O.sql(
    "SELECT nr_proposta, item_proposta, dt_upload FROM s_historico WHERE dt_upload IS NOT NULL"))
def q_not_null(spark, sf_dir):
    """F1."""
    h = W(spark, sf_dir).silver("historico")
    return h.select("nr_proposta", "item_proposta", "dt_upload").filter(F.col("dt_upload").isNotNull())


@register("calendar_existence_filter", O.sql("""
SELECT bk_ticket, dt_criacao, dt_atualizacao FROM s_tickets
WHERE dt_atualizacao IN (SELECT DATA FROM g_dim_time)"""))
def q_existence(spark, sf_dir):
    """keep tickets whose update date is in the calendar (semi join)."""
    w = W(spark, sf_dir, "dim_time", tickets=("bk_ticket", "dt_criacao", "dt_atualizacao"))
    t = w.silver("tickets").select("bk_ticket", "dt_criacao", "dt_atualizacao")
    return require_in(t, w.dim_time(), [(as_date("dt_atualizacao"), "DATA")])


@register("fact_tickets_rejects", O.sql("""
SELECT bk_ticket, reasons FROM (
  SELECT bk_ticket, concat_ws(',',
    CASE WHEN NOT coalesce(t.cd_cliente IN (SELECT CD_CLIENTE FROM g_client_keys WHERE CD_CLIENTE IS NOT NULL), false)
         THEN 'client' END,
    CASE WHEN NOT EXISTS (SELECT 1 FROM g_dim_priority p WHERE p.TIPO_PRIORIDADE = t.prioridade_ticket) THEN 'priority' END,
    CASE WHEN NOT EXISTS (SELECT 1 FROM g_dim_ticket d WHERE d.tipo_ticket = t.tipo_ticket
                          AND d.status_ticket = t.status_ticket) THEN 'ticket' END,
    CASE WHEN NOT EXISTS (SELECT 1 FROM g_dim_time c WHERE c.DATA = t.dt_criacao) THEN 'created' END,
    CASE WHEN NOT EXISTS (SELECT 1 FROM g_dim_time c WHERE c.DATA = t.dt_atualizacao) THEN 'updated' END) AS reasons
  FROM s_tickets t) WHERE reasons <> ''"""))
def q_ticket_rejects(spark, sf_dir):
    """every ticket that the ticket fact drops, with all lookups it fails,
    from one pass."""
    w = W(spark, sf_dir, "client_map", "dim_time", "fact_tickets", tickets=("bk_ticket",))
    got = facts.tickets_checked(w.silver("tickets"), w.client_map(), w.dim_priority(), w.dim_ticket(), w.dim_time())
    if got.rows < got.rejected or got.rejected > sum(got.failed.values()):
        raise RuntimeError(got)
    return got.quarantine.select("bk_ticket", F.array_join("reasons", ",").alias("reasons"))


@register("lookup_rejects", O.sql("""
SELECT nr_proposta, item_proposta, cd_cliente, cd_prod, dt_upload, 'cliente' AS reason
FROM s_historico h WHERE NOT EXISTS (SELECT 1 FROM g_client_keys k WHERE k.CD_CLIENTE = h.cd_cliente)
UNION ALL
SELECT nr_proposta, item_proposta, cd_cliente, cd_prod, dt_upload, 'produto'
FROM s_historico h WHERE NOT EXISTS (SELECT 1 FROM g_dim_product p WHERE p.CD_PRODUTO = h.cd_prod)
UNION ALL
SELECT nr_proposta, item_proposta, cd_cliente, cd_prod, dt_upload, 'tempo'
FROM s_historico h WHERE NOT EXISTS (SELECT 1 FROM g_dim_time t WHERE t.DATA = h.dt_upload)"""))
def q_lookup_rejects(spark, sf_dir):
    """proposal items each inner lookup of the contract fact drops."""
    w = W(spark, sf_dir, "client_map", "dim_product", "dim_time",
          historico=("nr_proposta", "item_proposta", "cd_cliente", "cd_prod", "dt_upload"))
    h = w.silver("historico").select("nr_proposta", "item_proposta", "cd_cliente", "cd_prod",
                                     "dt_upload")
    by_client = rejects(h, w.client_map(), [("cd_cliente", "CD_CLIENTE")])
    by_product = rejects(h, w.dim_product(), [("cd_prod", "CD_PRODUTO")])
    by_date = rejects(h, w.dim_time(), [(as_date("dt_upload"), "DATA")])
    return (by_client.withColumn("reason", F.lit("cliente"))
            .unionByName(by_product.withColumn("reason", F.lit("produto")))
            .unionByName(by_date.withColumn("reason", F.lit("tempo"))))


# ------------------------------------------------------------------ nulls
@register("fill_null_string", O.sql(
    "SELECT cd_cliente, ds_subsegmento, marca_totvs, modal_comerc FROM s_clientes_raw"))
def q_fill_string(spark, sf_dir):
    """N1."""
    c = silver_clients(W(spark, sf_dir).bronze("dados_clientes"), with_span=False)
    return c.select("cd_cliente", "ds_subsegmento", "marca_totvs", "modal_comerc")


@register("fill_null_sentinel", O.sql(
    "SELECT cd_cliente, " + ", ".join(O.ACQ_SUBS) + " FROM s_nps_aquisicao"))
def q_fill_sentinel(spark, sf_dir):
    """N2."""
    s = W(spark, sf_dir).silver("nps_transacional_aquisicao")
    return s.select("cd_cliente", *O.ACQ_SUBS)


@register("fill_null_zero", O.sql("""
SELECT h.nr_proposta, h.item_proposta, h.cd_cliente,
  coalesce(m.vlr_contratacoes_12m, 0) AS vlr_contratacoes_12m
FROM s_historico h LEFT JOIN s_contratacoes m ON h.cd_cliente = m.cd_cliente"""))
def q_fill_zero(spark, sf_dir):
    """Measure filled with 0 after the outer join."""
    w = W(spark, sf_dir)
    h = w.silver("historico").select("nr_proposta", "item_proposta", "cd_cliente")
    m = w.silver("contratacoes").select("cd_cliente", "vlr_contratacoes_12m")
    return fill_zero(enrich(h, m, "cd_cliente", "left"), ["vlr_contratacoes_12m"]) \
        .select("nr_proposta", "item_proposta", "cd_cliente", "vlr_contratacoes_12m")


# ---------------------------------------------------------------- scalars
@register("decimal_comma_parse", O.sql(f"""
SELECT NR_PROPOSTA AS chave, VL_TOTAL AS texto_total, VL_DESCONTO AS texto_desconto,
  {O.dcomma('VL_TOTAL')} AS vl_total, {O.dcomma('VL_DESCONTO')} AS vl_desconto FROM b_historico
UNION ALL
SELECT CD_CLIENTE, VL_TOTAL_CONTRATO, VL_TOTAL_CONTRATO, {O.dcomma('VL_TOTAL_CONTRATO')},
  {O.dcomma('VL_TOTAL_CONTRATO')} FROM b_clientes"""))
def q_decimal_comma(spark, sf_dir):
    """Includes thousands-dot and 'n/d' text (-> NULL)."""
    w = W(spark, sf_dir)
    h = w.bronze("historico").select(
        F.col("NR_PROPOSTA").alias("chave"), F.col("VL_TOTAL").alias("texto_total"),
        F.col("VL_DESCONTO").alias("texto_desconto"),
        decimal_comma("VL_TOTAL").alias("vl_total"), decimal_comma("VL_DESCONTO").alias("vl_desconto"))
    c = w.bronze("dados_clientes").select(
        F.col("CD_CLIENTE").alias("chave"), F.col("VL_TOTAL_CONTRATO").alias("texto_total"),
        F.col("VL_TOTAL_CONTRATO").alias("texto_desconto"),
        decimal_comma("VL_TOTAL_CONTRATO").alias("vl_total"),
        decimal_comma("VL_TOTAL_CONTRATO").alias("vl_desconto"))
    return h.unionByName(c)


@register("cast_int", O.sql(f"""
SELECT "Cod Cliente" AS cd_cliente, "Nota NPS" AS nota_texto, {O.to_int('"Nota NPS"')} AS nota_nps
FROM b_nps_aquisicao"""))
def q_cast_int(spark, sf_dir):
    """C2: '7.0' -> 7 through double."""
    b = W(spark, sf_dir).bronze("nps_transacional_aquisicao")
    return b.select(col("Cod Cliente").alias("cd_cliente"), col("Nota NPS").alias("nota_texto"),
                    to_int(col("Nota NPS")).alias("nota_nps"))


@register("parse_date_iso", O.sql(
    f"SELECT NR_PROPOSTA, DT_UPLOAD AS texto, {O.iso_date('DT_UPLOAD')} AS dt_upload FROM b_historico"))
def q_parse_iso(spark, sf_dir):
    """Patterned date; trailing time text -> NULL."""
    b = W(spark, sf_dir).bronze("historico")
    return b.select("NR_PROPOSTA", col("DT_UPLOAD").alias("texto"), parse_date("DT_UPLOAD", ISO_DATE).alias("dt_upload"))


@register("parse_date_default", O.sql(
    f"SELECT respondedAt, {O.any_date('respondedAt')} AS dt_resposta FROM b_nps_relacional"))
def q_parse_default(spark, sf_dir):
    """C4: un-patterned date (accepts a trailing time)."""
    b = W(spark, sf_dir).bronze("nps_relacional")
    return b.select("respondedAt", as_date("respondedAt").alias("dt_resposta"))


@register("parse_date_us_meridiem", O.sql(
    f'SELECT "Data da Resposta" AS texto, {O.us_date(chr(34) + "Data da Resposta" + chr(34))} '
    "AS dt_resposta FROM b_nps_produto"))
def q_parse_us(spark, sf_dir):
    """12- and 24-hour clock with a meridiem; bad text -> NULL."""
    b = W(spark, sf_dir).bronze("nps_transacional_produto")
    return b.select(col("Data da Resposta").alias("texto"),
                    parse_date_us(col("Data da Resposta")).alias("dt_resposta"))


@register("parse_iso_timestamp_date", O.sql(
    """SELECT "Data de resposta" AS texto,
    CAST(try_strptime("Data de resposta", '%Y-%m-%dT%H:%M:%S') AS DATE) AS dt_resposta
    FROM b_nps_onboarding"""))
def q_parse_iso_t(spark, sf_dir):
    """C6."""
    b = W(spark, sf_dir).bronze("nps_transacional_onboarding")
    return b.select(col("Data de resposta").alias("texto"),
                    parse_ts_date(col("Data de resposta")).alias("dt_resposta"))


@register("resolution_days", O.sql(
    "SELECT bk_ticket, dt_criacao, dt_atualizacao, tempo_resolucao_dias FROM s_tickets"))
def q_resolution_days(spark, sf_dir):
    """Negative when the update precedes the creation."""
    return W(spark, sf_dir).silver("tickets").select(
        "bk_ticket", "dt_criacao", "dt_atualizacao", "tempo_resolucao_dias")


@register("date_smart_key", O.sql("""
SELECT DISTINCT dt_upload, CAST(year(dt_upload) * 10000 + month(dt_upload) * 100
  + day(dt_upload) AS INTEGER) AS SK_TEMPO FROM s_historico WHERE dt_upload IS NOT NULL"""))
def q_date_key(spark, sf_dir):
    """C8."""
    h = W(spark, sf_dir).silver("historico").select("dt_upload").filter(
        F.col("dt_upload").isNotNull()).distinct()
    return h.select("dt_upload", date_key("dt_upload").alias("SK_TEMPO"))


@register("calendar_attributes", O.sql("""
SELECT DISTINCT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS SK_TEMPO, d AS DATA,
  CAST(year(d) AS INTEGER) AS ANO, CAST(month(d) AS INTEGER) AS MES, strftime(d, '%B') AS NOME_MES,
  'Q' || CAST(quarter(d) AS VARCHAR) AS TRIMESTRE
FROM (SELECT dt_criacao AS d FROM s_tickets) WHERE d IS NOT NULL"""))
def q_calendar_attributes(spark, sf_dir):
    """Year, month, English month name, quarter label."""
    t = W(spark, sf_dir).silver("tickets").select(F.col("dt_criacao").alias("d")) \
        .filter(F.col("d").isNotNull()).distinct()
    return t.select(*calendar_attributes("d"))


# ------------------------------------------------------------------ joins
@register("join_inner_using_m2m", O.sql("""
SELECT c.cd_cliente, c.n_codes, d.n_descriptions, c.n_codes * d.n_descriptions AS n_pairs
FROM (SELECT cd_cliente, count(*) AS n_codes FROM g_codes GROUP BY 1) c
JOIN (SELECT cd_cliente, count(*) AS n_descriptions FROM g_descs GROUP BY 1) d
ON c.cd_cliente = d.cd_cliente"""))
def q_m2m(spark, sf_dir):
    """Size of the (client, code) x (client, description) join per
    client, computed from per-client counts (the pairs are not emitted)."""
    w = W(spark, sf_dir)
    return cooccurrence_pairs_per_client(w.silver("historico"), w.silver("clientes"))


@register("join_enrich_ticket_date", O.sql(
    "SELECT bk_ticket, cd_cliente, nota_nps, dt_resposta FROM g_support_enriched"))
def q_enrich(spark, sf_dir):
    """Support answers dated by their ticket (one date per ticket)."""
    w = W(spark, sf_dir)
    return facts.support_enriched(w.silver("nps_transacional_suporte"), w.silver("tickets")) \
        .select("bk_ticket", "cd_cliente", "nota_nps", "dt_resposta")


@register("join_enrich_hot_tickets", O.sql(
    "SELECT bk_ticket, cd_cliente, nota_nps, dt_resposta FROM g_support_enriched"))
def q_enrich_hot(spark, sf_dir):
    """J2 with hot tickets kept out of the shuffle."""
    w = W(spark, sf_dir)
    return facts.support_enriched(w.silver("nps_transacional_suporte"), w.silver("tickets"), split_hot=True) \
        .select("bk_ticket", "cd_cliente", "nota_nps", "dt_resposta")


@register("lookup_hot_product_name", O.sql(
    "SELECT cd_cliente, nome_produto, nota_nps, CD_PRODUTO FROM g_product_enriched"))
def q_lookup_hot_name(spark, sf_dir):
    """J5 with hot names (a tenth of the answers has the placeholder) kept
    out of the shuffle."""
    w = W(spark, sf_dir, "dim_product",
          nps_transacional_produto=("cd_cliente", "nome_produto", "nota_nps"))
    return facts.product_enriched(w.silver("nps_transacional_produto"), w.dim_product(), split_hot=True) \
        .select("cd_cliente", "nome_produto", "nota_nps", "CD_PRODUTO")


@register("lookup_hot_name_left", O.sql("""
SELECT t.bk_ticket, t.nome_grupo, p.SK_PRODUTO
FROM s_tickets t LEFT JOIN g_products_by_name p ON t.nome_grupo = p.DS_PRODUTO"""))
def q_lookup_hot_left(spark, sf_dir):
    """J10 with hot names kept out of the shuffle."""
    w = W(spark, sf_dir, "dim_product", tickets=("bk_ticket", "nome_grupo"))
    t = w.silver("tickets").select("bk_ticket", "nome_grupo")
    return lookup_split(t, dims.products_by_name(w.dim_product()), ("nome_grupo", "DS_PRODUTO"), ["SK_PRODUTO"],
                        how="left")


@register("lookup_client", O.sql("""
SELECT h.nr_proposta, h.item_proposta, h.cd_cliente, k.SK_CLIENTE
FROM s_historico h JOIN g_client_keys k ON h.cd_cliente = k.CD_CLIENTE"""))
def q_lookup_client(spark, sf_dir):
    """Differently named keys; one surviving key per client."""
    w = W(spark, sf_dir, "client_map", historico=("nr_proposta", "item_proposta", "cd_cliente"))
    h = w.silver("historico").select("nr_proposta", "item_proposta", "cd_cliente")
    return lookup(h, w.client_map(), [("cd_cliente", "CD_CLIENTE")],
                  ["SK_CLIENTE"])


@register("lookup_product_code", O.sql("""
SELECT h.nr_proposta, h.item_proposta, h.cd_prod, p.SK_PRODUTO
FROM s_historico h JOIN g_dim_product p ON h.cd_prod = p.CD_PRODUTO"""))
def q_lookup_product(spark, sf_dir):
    """J4."""
    w = W(spark, sf_dir, "dim_product", historico=("nr_proposta", "item_proposta", "cd_prod"))
    h = w.silver("historico").select("nr_proposta", "item_proposta", "cd_prod")
    return lookup(h, w.dim_product(), [("cd_prod", "CD_PRODUTO")], ["SK_PRODUTO"])


@register("lookup_product_name", O.sql(
    "SELECT cd_cliente, nome_produto, nota_nps, CD_PRODUTO FROM g_product_enriched"))
def q_lookup_product_name(spark, sf_dir):
    """Text key, one code per name."""
    w = W(spark, sf_dir, "dim_product",
          nps_transacional_produto=("cd_cliente", "nome_produto", "nota_nps"))
    return facts.product_enriched(w.silver("nps_transacional_produto"), w.dim_product()) \
        .select("cd_cliente", "nome_produto", "nota_nps", "CD_PRODUTO")


@register("join_expr_key", O.sql("""
SELECT h.nr_proposta, h.item_proposta, h.dt_upload, t.SK_TEMPO
FROM s_historico h JOIN g_dim_time t ON h.dt_upload = t.DATA"""))
def q_join_expr(spark, sf_dir):
    """Calendar lookup on a derived date key."""
    w = W(spark, sf_dir, "dim_time", historico=("nr_proposta", "item_proposta", "dt_upload"))
    h = w.silver("historico").select("nr_proposta", "item_proposta", "dt_upload")
    return lookup(h, w.dim_time(), [(as_date("dt_upload"), "DATA")], ["SK_TEMPO"])


@register("join_left_metric", O.sql("""
SELECT h.cd_cliente, h.nr_proposta, h.item_proposta, m.vlr_contratacoes_12m
FROM s_historico h LEFT JOIN s_contratacoes m ON h.cd_cliente = m.cd_cliente"""))
def q_left_metric(spark, sf_dir):
    """Left USING join, NULL where the client has no 12-month rollup."""
    w = W(spark, sf_dir)
    h = w.silver("historico").select("cd_cliente", "nr_proposta", "item_proposta")
    m = w.silver("contratacoes").select("cd_cliente", "vlr_contratacoes_12m")
    return enrich(h, m, "cd_cliente", "left")


@register("join_left_product", O.sql("""
SELECT s.cd_cliente, s.tipo_nps, s.cd_prod, p.SK_PRODUTO
FROM g_surveys s LEFT JOIN g_dim_product p ON s.cd_prod = p.CD_PRODUTO"""))
def q_left_product(spark, sf_dir):
    """Left lookup by code (unique), never changes the row count."""
    w = W(spark, sf_dir, "dim_product", "surveys")
    s = w.surveys().select("cd_cliente", "tipo_nps", "cd_prod")
    return lookup(s, w.dim_product(), [("cd_prod", "CD_PRODUTO")], ["SK_PRODUTO"], how="left")


@register("join_broadcast_lookup", O.sql("""
SELECT t.bk_ticket, p.SK_PRIORIDADE, d.sk_ticket
FROM s_tickets t JOIN g_dim_priority p ON t.prioridade_ticket = p.TIPO_PRIORIDADE
JOIN g_dim_ticket d ON t.tipo_ticket = d.tipo_ticket AND t.status_ticket = d.status_ticket"""))
def q_broadcast_lookup(spark, sf_dir):
    """Bounded dimensions broadcast after a size check."""
    w = W(spark, sf_dir)
    t = w.silver("tickets").select("bk_ticket", "prioridade_ticket", "tipo_ticket", "status_ticket")
    df = lookup(t, w.dim_priority(), [("prioridade_ticket", "TIPO_PRIORIDADE")], ["SK_PRIORIDADE"])
    df = lookup(df, w.dim_ticket(), [("tipo_ticket", "tipo_ticket"),
                                     ("status_ticket", "status_ticket")], ["sk_ticket"])
    return df.select("bk_ticket", "SK_PRIORIDADE", "sk_ticket")


@register("join_broadcast_left", O.sql("""
SELECT t.bk_ticket, t.nome_grupo, p.SK_PRODUTO
FROM s_tickets t LEFT JOIN g_products_by_name p ON t.nome_grupo = p.DS_PRODUTO"""))
def q_broadcast_left(spark, sf_dir):
    """Left lookup by product name (one code per name)."""
    w = W(spark, sf_dir, "dim_product", tickets=("bk_ticket", "nome_grupo"))
    t = w.silver("tickets").select("bk_ticket", "nome_grupo")
    return lookup(t, dims.products_by_name(w.dim_product()), [("nome_grupo", "DS_PRODUTO")],
                  ["SK_PRODUTO"], how="left")


@register("role_playing_dates", O.sql("""
SELECT t.bk_ticket, c.SK_TEMPO AS SK_TEMPO_CRIACAO, u.SK_TEMPO AS SK_TEMPO_ATUALIZACAO
FROM s_tickets t JOIN g_dim_time c ON t.dt_criacao = c.DATA
JOIN g_dim_time u ON t.dt_atualizacao = u.DATA"""))
def q_role_playing(spark, sf_dir):
    """One calendar in two roles."""
    w = W(spark, sf_dir, "dim_time", tickets=("bk_ticket", "dt_criacao", "dt_atualizacao"))
    t = w.silver("tickets").select("bk_ticket", "dt_criacao", "dt_atualizacao")
    r = role_join(t, w.dim_time(), "DATA", "SK_TEMPO",
                  {"SK_TEMPO_CRIACAO": as_date("dt_criacao"),
                   "SK_TEMPO_ATUALIZACAO": as_date("dt_atualizacao")})
    return r.select("bk_ticket", "SK_TEMPO_CRIACAO", "SK_TEMPO_ATUALIZACAO")


# ------------------------------------------------------- aggregation/dedup
@register("distinct_rows", O.sql("SELECT DISTINCT cd_cliente, cd_prod FROM s_historico"))
def q_distinct(spark, sf_dir):
    """A1."""
    return distinct_rows(W(spark, sf_dir).silver("historico").select("cd_cliente", "cd_prod"))


@register("drop_duplicates_all", O.sql(
    "SELECT DISTINCT tipo_ticket, status_ticket, prioridade_ticket FROM s_tickets"))
def q_drop_dups(spark, sf_dir):
    """A2."""
    t = W(spark, sf_dir).silver("tickets").select("tipo_ticket", "status_ticket",
                                                  "prioridade_ticket")
    return drop_duplicates_all(t)


_CLIENT_COLS = SILVER["clientes"].names


@register("keep_one_per_key", O.sql(
    f"SELECT {', '.join(_CLIENT_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY cd_cliente "
    f"ORDER BY {O.order_by(_CLIENT_COLS[1:])}) AS rn FROM s_clientes) WHERE rn = 1"))
def q_keep_one(spark, sf_dir):
    """A3: one deterministic contract row per client (smallest in schema
    order), as a partial min-aggregation."""
    return keep_one(W(spark, sf_dir).silver("clientes"), ["cd_cliente"])


@register("infer_product_map", O.select_all("g_product_map"))
def q_infer(spark, sf_dir):
    """A4."""
    w = W(spark, sf_dir, "dim_product")
    return infer_product_map(w.silver("historico"), w.clients_raw())


@register("infer_family_map", O.sql("""
SELECT CD_PRODUTO, DS_PRODUTO, DS_LINHA_RECEITA FROM (
  SELECT *, row_number() OVER (PARTITION BY CD_PRODUTO ORDER BY n DESC, DS_PRODUTO NULLS FIRST,
                                                            DS_LINHA_RECEITA NULLS FIRST) AS rn
  FROM (SELECT f AS CD_PRODUTO, DS_PRODUTO, DS_LINHA_RECEITA, count(*) AS n
        FROM (SELECT DISTINCT cd_cliente, substr(CAST(cd_prod AS VARCHAR), 1, 2) AS f FROM s_historico
              WHERE cd_cliente IS NOT NULL AND cd_prod IS NOT NULL) JOIN g_descs USING (cd_cliente)
        GROUP BY ALL)) WHERE rn = 1"""))
def q_infer_family(spark, sf_dir):
    """A4 where no client sets are equal: the description that shares most
    clients with a product family (the code's first two digits)."""
    w = W(spark, sf_dir, "dim_product")
    family = w.silver("historico").withColumn("cd_prod", F.substring(F.col("cd_prod").cast("string"), 1, 2))
    return infer_product_map(family, w.clients_raw())


@register("row_count_audit", O.sql(" UNION ALL ".join(
    f"SELECT '{e}' AS entity, count(*) AS n_rows FROM {cte}" for e, cte in [
        ("clientes", "s_clientes_raw"), ("contratacoes", "s_contratacoes"),
        ("historico", "s_historico"), ("tickets", "s_tickets"), ("telemetria", "s_telemetria"),
        ("nps_relacional", "s_nps_relacional"), ("nps_transacional_produto", "s_nps_produto"),
        ("nps_transacional_aquisicao", "s_nps_aquisicao"),
        ("nps_transacional_onboarding", "s_nps_onboarding"),
        ("nps_transacional_suporte", "s_nps_suporte")])))
def q_row_count(spark, sf_dir):
    """A5: row count of every silver table, observed while it is written."""
    w = W(spark, sf_dir)
    counts = []
    for entity, (src, job) in SILVER_JOBS.items():
        df = silver_clients(w.bronze(src), with_span=False) if entity == "clientes" \
            else job(w.bronze(src))
        seen, rows = observe_rows(df)
        write_parquet(seen, scratch_path(spark, f"audit_{entity}"))
        counts.append((entity, rows.get["rows"]))
    return spark.createDataFrame(counts, "entity string, n_rows bigint")


@register("client_contract_span", O.sql(
    "SELECT cd_cliente, dt_assinatura_contrato, dt_inicio_contrato, dt_ultimo_contrato "
    "FROM s_clientes"))
def q_span(spark, sf_dir):
    """A6 (row grain): first/last contract date on every contract row."""
    return W(spark, sf_dir).silver("clientes").select(
        "cd_cliente", "dt_assinatura_contrato", "dt_inicio_contrato", "dt_ultimo_contrato")


@register("client_contract_rollup", O.sql("""
SELECT cd_cliente, min(dt_assinatura_contrato) AS dt_inicio_contrato,
  max(dt_assinatura_contrato) AS dt_ultimo_contrato FROM s_clientes_raw GROUP BY cd_cliente"""))
def q_rollup(spark, sf_dir):
    """A6 (client grain)."""
    c = silver_clients(W(spark, sf_dir).bronze("dados_clientes"), with_span=False)
    return contract_span(c)


# ---------------------------------------------------------------- windows
@register("surrogate_key_dim", O.sql(O.keyed(
    "SK_CLIENTE", ["CD_CLIENTE"], "(SELECT DISTINCT cd_cliente AS CD_CLIENTE FROM s_clientes)",
    None, "INTEGER")))
def q_surrogate(spark, sf_dir):
    """Key over a distinct natural key, computed distributed."""
    c = W(spark, sf_dir).silver("clientes").select(F.col("cd_cliente").alias("CD_CLIENTE")).distinct()
    return surrogate_key(c, "SK_CLIENTE", ["CD_CLIENTE"])


_HIST_COLS = SILVER["historico"].names


@register("dense_key_fact", O.sql(O.keyed("SK_ITEM", _HIST_COLS, "s_historico",
                                          ["nr_proposta", "item_proposta"])))
def q_dense_key(spark, sf_dir):
    """Dense bigint key over every proposal item (copies included)."""
    h = with_row_identity(W(spark, sf_dir).silver("historico"))
    return dense_key(h, "SK_ITEM", order_by=["nr_proposta", "item_proposta"],
                     tiebreak=ROW_ID)


# ---------------------------------------------------------------- sort/set
@register("calendar_sorted", O.sql("SELECT * FROM g_dim_time ORDER BY SK_TEMPO"))
def q_calendar_sorted(spark, sf_dir):
    """O1."""
    return W(spark, sf_dir, "dim_time").dim_time().orderBy("SK_TEMPO")


@register("union_distinct_dates", O.sql("""
SELECT DATA FROM (SELECT dt_ultimo_contrato AS DATA FROM s_clientes UNION SELECT dt_criacao
FROM s_tickets UNION SELECT dt_upload FROM s_historico) WHERE DATA IS NOT NULL"""))
def q_union_dates(spark, sf_dir):
    """U1."""
    w = W(spark, sf_dir)
    return observed_dates((w.silver("clientes"), "dt_ultimo_contrato"),
                          (w.silver("tickets"), "dt_criacao"),
                          (w.silver("historico"), "dt_upload"))


@register("union_by_name", O.select_all("g_surveys"))
def q_union_by_name(spark, sf_dir):
    """Five survey feeds with typed NULL alignment."""
    return W(spark, sf_dir, "dim_product", "surveys").surveys()


# ------------------------------------------------------------- silver jobs
def _silver(entity: str, job, cte: str, src: str):
    def run(spark, sf_dir):
        path, sep = scratch_path(spark, f"landed_{src}"), BRONZE_FILES[src][1]
        write_csv(W(spark, sf_dir).bronze(src), path, sep=sep)
        return job(read_csv(spark, path, BRONZE[src], sep=sep))
    run.__doc__ = f"silver {entity}: the extract landed as text, scanned and parsed"
    return run


for _name, _entity, _job, _cte, _src in [
    ("silver_clients", "clientes", silver_clients, "s_clientes", "dados_clientes"),
    ("silver_contracts_12m", "contratacoes", silver_contracts_12m, "s_contratacoes",
     "contratacoes_ultimos_12_meses"),
    ("silver_history", "historico", silver_history, "s_historico", "historico"),
    ("silver_tickets", "tickets", silver_tickets, "s_tickets", "tickets"),
    ("silver_telemetry", "telemetria", silver_telemetry, "s_telemetria", "telemetria"),
    ("silver_nps_relational", "nps_relacional", silver_nps_relational, "s_nps_relacional",
     "nps_relacional"),
    ("silver_nps_product", "nps_transacional_produto", silver_nps_product, "s_nps_produto",
     "nps_transacional_produto"),
    ("silver_nps_acquisition", "nps_transacional_aquisicao", silver_nps_acquisition,
     "s_nps_aquisicao", "nps_transacional_aquisicao"),
    ("silver_nps_onboarding", "nps_transacional_onboarding", silver_nps_onboarding,
     "s_nps_onboarding", "nps_transacional_onboarding"),
    ("silver_nps_support", "nps_transacional_suporte", silver_nps_support, "s_nps_suporte",
     "nps_transacional_suporte"),
]:
    register(_name, _silver_sql(_entity, _cte))(_silver(_entity, _job, _cte, _src))


# ------------------------------------------------------------ gold jobs
@register("dim_time", O.select_all("g_dim_time"))
def q_dim_time(spark, sf_dir):
    """PL11."""
    return W(spark, sf_dir, "dim_time").dim_time()


@register("dim_time_all_dates", O.sql("""
SELECT CAST(year(DATA) * 10000 + month(DATA) * 100 + day(DATA) AS INTEGER) AS SK_TEMPO, DATA,
  CAST(year(DATA) AS INTEGER) AS ANO, CAST(month(DATA) AS INTEGER) AS MES,
  strftime(DATA, '%B') AS NOME_MES, 'Q' || CAST(quarter(DATA) AS VARCHAR) AS TRIMESTRE
FROM (SELECT dt_ultimo_contrato AS DATA FROM s_clientes UNION SELECT dt_criacao FROM s_tickets
      UNION SELECT dt_upload FROM s_historico UNION SELECT dt_resposta FROM s_nps_relacional
      UNION SELECT dt_resposta FROM s_nps_produto UNION SELECT dt_resposta FROM s_nps_aquisicao
      UNION SELECT dt_resposta FROM s_nps_onboarding UNION SELECT dt_atualizacao FROM s_tickets)
WHERE DATA IS NOT NULL"""))
def q_dim_time_all_dates(spark, sf_dir):
    """PL11 with the D11 option: the calendar also covers survey-answer and
    ticket-update dates."""
    w = W(spark, sf_dir, "dim_time", tickets=("dt_atualizacao",), **{e: ("dt_resposta",) for e in (
        "nps_relacional", "nps_transacional_produto", "nps_transacional_aquisicao", "nps_transacional_onboarding")})
    extra = [(w.silver(e), "dt_resposta") for e in (
        "nps_relacional", "nps_transacional_produto", "nps_transacional_aquisicao",
        "nps_transacional_onboarding")] + [(w.silver("tickets"), "dt_atualizacao")]
    return dims.dim_time(contract_span(w.clients_raw()), w.silver("tickets"),
                         w.silver("historico"), extra_dates=extra, sort=False)


@register("dim_client", O.select_all("g_dim_client"))
def q_dim_client(spark, sf_dir):
    """PL12."""
    return W(spark, sf_dir).dim_client()


@register("dim_product", O.select_all("g_dim_product"))
def q_dim_product(spark, sf_dir):
    """PL13."""
    return W(spark, sf_dir, "dim_product").dim_product()


@register("dim_priority", O.select_all("g_dim_priority"))
def q_dim_priority(spark, sf_dir):
    """PL14."""
    return W(spark, sf_dir).dim_priority()


@register("dim_ticket", O.select_all("g_dim_ticket"))
def q_dim_ticket(spark, sf_dir):
    """PL15."""
    return W(spark, sf_dir).dim_ticket()


@register("fact_contracts", O.select_all("g_fact_contracts"))
def q_fact_contracts(spark, sf_dir):
    """PL16 (flagship)."""
    return W(spark, sf_dir, "client_map", "dim_product", "dim_time", "fact_contracts").fact_contracts()


@register("fact_tickets", O.select_all("g_fact_tickets"))
def q_fact_tickets(spark, sf_dir):
    """PL17."""
    return W(spark, sf_dir, "client_map", "dim_time", "fact_tickets").fact_tickets()


@register("fact_nps", O.select_all("g_fact_nps"))
def q_fact_nps(spark, sf_dir):
    """PL18."""
    return W(spark, sf_dir, "client_map", "dim_product", "dim_time", "surveys").fact_nps()


# --------------------------------------------------- literal semantics
@register("lookup_expand_grain", O.sql("""
SELECT h.cd_cliente, h.n_items, d.n_dim_rows, h.n_items * d.n_dim_rows AS n_expanded
FROM (SELECT cd_cliente, count(*) AS n_items FROM s_historico GROUP BY 1) h
JOIN (SELECT CD_CLIENTE, count(*) AS n_dim_rows FROM g_dim_client GROUP BY 1) d
ON h.cd_cliente = d.CD_CLIENTE"""))
def q_expand_grain(spark, sf_dir):
    """D3: rows the literal client lookup (every contract row of the
    client) would produce, per client, from two per-client counts."""
    w = W(spark, sf_dir)
    h = w.silver("historico").groupBy("cd_cliente").agg(F.count(F.lit(1)).alias("n_items"))
    d = w.dim_client().groupBy("CD_CLIENTE").agg(F.count(F.lit(1)).alias("n_dim_rows"))
    j = lookup(h, d, [("cd_cliente", "CD_CLIENTE")], ["n_dim_rows"], broadcast=False)
    return j.select("cd_cliente", "n_items", "n_dim_rows",
                    (F.col("n_items") * F.col("n_dim_rows")).alias("n_expanded"))


@register("lookup_partial_key", O.sql("""
SELECT t.tipo_ticket, t.n_tickets, d.n_keys, t.n_tickets * d.n_keys AS n_rows
FROM (SELECT tipo_ticket, count(*) AS n_tickets FROM s_tickets GROUP BY 1) t
JOIN (SELECT tipo_ticket, count(*) AS n_keys FROM g_dim_ticket GROUP BY 1) d
ON t.tipo_ticket = d.tipo_ticket"""))
def q_partial_key(spark, sf_dir):
    """Rows the type-only ticket lookup would produce, per type."""
    w = W(spark, sf_dir)
    t = w.silver("tickets").groupBy("tipo_ticket").agg(F.count(F.lit(1)).alias("n_tickets"))
    d = w.dim_ticket().groupBy("tipo_ticket").agg(F.count(F.lit(1)).alias("n_keys"))
    j = lookup(t, d, [("tipo_ticket", "tipo_ticket")], ["n_keys"])
    return j.select("tipo_ticket", "n_tickets", "n_keys",
                    (F.col("n_tickets") * F.col("n_keys")).alias("n_rows"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v.run for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v.oracle for k, v in REGISTRY.items() if v.oracle is not None}
