"""Bronze extracts derived from the driver's test tables.

The source project ships no sample data, so each raw extract is rebuilt
from the TPC-H-like tables as *text* in the extract's own format
(decimal-comma money, ISO / US-meridiem / ISO-T dates, empty cells) with
the extract's header names.  Everything is a distributed DataFrame over
the whole tables, so the pipeline's work grows with them.

Mapping (test table -> extract):

* ``dados_clientes``   one contract row per lineitem (lineitem, orders,
  customer, nation, part)
* ``historico``        one proposal item per lineitem (lineitem, orders)
* ``tickets``          one ticket row per lineitem (lineitem, orders, part)
* ``contratacoes_ultimos_12_meses``  per client rollup of orders placed in
  the last 12 months of the order history
* NPS feeds and telemetry from ``events`` (one feed per event type, survey
  dates shifted back 27 years into the order history)

A few cells are rendered in bad or odd forms on purpose (thousands dots,
trailing time after a date, ``n/d``, ``7.0`` for an integer, 24-hour
clock with a meridiem) so the parsers' NULL-on-bad-text rules are
exercised on every run.  Some proposal items are repeated for an unknown
client and product code, and some tickets name an unknown client, an
update date outside the calendar or an id beyond 2^53, so every lookup
has something to reject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.schemas import BRONZE

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events")

# fixed values: the survey date shift, the 12-month window start, the offset
# of ticket ids that a double cannot hold
SURVEY_SHIFT_YEARS = 27
WINDOW_START = "2000-08-01"
WIDE_ID = 9007199254740993


# the large tables that drive the row count of every extract, with the
# columns their rows are hashed on when spread (several columns, so no
# single hot value decides a partition)
_STREAM_TABLES = {"lineitem": ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
                  "events": ("event_id", "user_id")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table.  The large ones are spread over the cluster when their
    scan is narrower than the default parallelism (each test file holds one
    row group, so it would otherwise be processed by a single task; real
    landings of many files are left as they are).  Small tables stay as
    scanned: they are broadcast to the large side."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, _STREAM_TABLES[name]) if name in _STREAM_TABLES else df


def spread(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Hash-repartition ``df`` to the default parallelism if its scan has
    fewer partitions (hashing needs no pre-sort, unlike round robin, and
    is deterministic on retry)."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if target > 1 and df.rdd.getNumPartitions() < target:
        return df.repartition(target, *keys)
    return df


def _cents(x: Column) -> Column:
    return F.round(x * 100).cast("bigint")


def _money_text(cents: Column, sep: str = ",") -> Column:
    """Non-negative cents -> '1234,56' (or with another separator)."""
    return F.concat(F.floor(cents / 100).cast("bigint").cast("string"), F.lit(sep),
                    F.lpad((cents % 100).cast("string"), 2, "0"))


def _thousands_text(cents: Column) -> Column:
    """'1.234,56' style: thousands dot before the last three integer digits
    (unparseable by the decimal-comma rule, so it must become NULL)."""
    ip = F.floor(cents / 100).cast("bigint")
    return F.concat(F.floor(ip / 1000).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((ip % 1000).cast("string"), 3, "0"), F.lit(","),
                    F.lpad((cents % 100).cast("string"), 2, "0"))


def _date_text(ts: Column) -> Column:
    return ts.cast("date").cast("string")       # the text of 'yyyy-MM-dd' without a formatter per row


def _s(c: Column) -> Column:
    return c.cast("string")


def _product_name(name: Column, key: Column) -> Column:
    return F.concat(name, F.lit(" #"), _s(key))


def _score_text(eid: Column, i: int) -> Column:
    """Sub-score 1..4, empty (NULL) for every fifth answer."""
    v = (eid + i) % 5
    return F.when(v == 0, F.lit(None).cast("string")).otherwise(_s(v))


def _lineitem_orders(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner")


def dados_clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the customer meets the orders, so that the items are not dealt out once
    # more by customer, and the part the items before they are widened
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    cu = table(spark, sf_dir, "customer")
    na = table(spark, sf_dir, "nation")
    pa = table(spark, sf_dir, "part")
    placed = (od.join(cu, od.o_custkey == cu.c_custkey)
                .join(na, F.col("c_nationkey") == na.n_nationkey))
    df = (li.join(pa, li.l_partkey == pa.p_partkey)
            .join(placed, F.col("l_orderkey") == placed.o_orderkey))
    cents = _cents(F.col("o_totalprice"))
    out = df.select(
        _s(F.col("o_custkey")).alias("CD_CLIENTE"),
        F.col("c_name").alias("CIDADE"),
        F.col("p_type").alias("DS_CNAE"),
        F.col("c_mktsegment").alias("DS_SEGMENTO"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("DS_SUBSEGMENTO"),
        _product_name(F.col("p_name"), F.col("p_partkey")).alias("DS_PROD"),
        F.col("p_brand").alias("DS_LIN_REC"),
        F.col("o_orderpriority").alias("FAT_FAIXA"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("MARCA_TOTVS"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("MODAL_COMERC"),
        F.col("o_orderstatus").alias("SITUACAO_CONTRATO"),
        F.col("n_name").alias("UF"),
        F.when(F.col("l_linenumber") == 7, _thousands_text(cents))
         .otherwise(_money_text(cents)).alias("VL_TOTAL_CONTRATO"),
        _date_text(F.col("o_orderdate")).alias("DT_ASSINATURA_CONTRATO"),
    )
    return out.select(*BRONZE["dados_clientes"].names)


def historico(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = _lineitem_orders(spark, sf_dir)
    full = _cents(F.col("l_extendedprice"))
    disc = _cents(F.col("l_extendedprice") * F.col("l_discount"))
    okey = F.col("l_orderkey")
    # first items of some proposals come a second time, for nobody known
    again = F.when((okey % 97 == 0) & (F.col("l_linenumber") == 1), F.array(F.lit(""), F.lit("X")))
    lo = lo.withColumn("stray", F.explode(F.coalesce(again, F.array(F.lit("")))))
    return lo.select(
        _s(okey).alias("NR_PROPOSTA"),
        _s(F.col("l_linenumber")).alias("ITEM_PROPOSTA"),
        F.when(okey % 211 == 0, F.concat(_date_text(F.col("l_shipdate")), F.lit(" 00:00:00")))
         .otherwise(_date_text(F.col("l_shipdate"))).alias("DT_UPLOAD"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("HOSPEDAGEM"),
        F.concat("stray", _s(F.col("o_custkey"))).alias("CD_CLI"),
        F.col("o_orderpriority").alias("FAT_FAIXA"),
        F.concat("stray", _s(F.col("l_partkey"))).alias("CD_PROD"),
        _money_text(_cents(F.col("l_quantity"))).alias("QTD"),
        _s(F.col("l_linenumber") % 4).alias("MESES_BONIF"),
        _money_text(full - disc).alias("VL_TOTAL"),
        _money_text(full).alias("VL_FULL"),
        F.when(okey % 101 == 0, F.lit("n/d")).otherwise(_money_text(disc)).alias("VL_DESCONTO"),
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = _lineitem_orders(spark, sf_dir)
    pa = table(spark, sf_dir, "part")
    df = lo.join(pa, lo.l_partkey == pa.p_partkey)
    okey = F.col("l_orderkey")
    return df.select(
        F.concat(F.when(okey % 89 == 0, "X").otherwise(""),
                 _s(F.col("o_custkey"))).alias("CODIGO_ORGANIZACAO"),
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("string"))
         .otherwise(_product_name(F.col("p_name"), F.col("p_partkey"))).alias("NOME_GRUPO"),
        F.col("l_returnflag").alias("TIPO_TICKET"),
        F.col("o_orderstatus").alias("STATUS_TICKET"),
        F.col("o_orderpriority").alias("PRIORIDADE_TICKET"),
        _s(F.when(okey % 83 == 0, okey + WIDE_ID).otherwise(okey)).alias("BK_TICKET"),
        _date_text(F.col("o_orderdate")).alias("DT_CRIACAO"),
        _date_text(F.when(okey % 79 == 0, F.col("l_shipdate") + F.expr("INTERVAL 40 YEARS"))
                   .otherwise(F.col("l_shipdate"))).alias("DT_ATUALIZACAO"),
    )


def contratacoes_12m(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = table(spark, sf_dir, "orders")
    agg = (od.filter(F.col("o_orderdate") >= F.lit(WINDOW_START).cast("timestamp_ntz"))
             .groupBy("o_custkey")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.sum(_cents(F.col("o_totalprice"))).alias("cents")))
    return agg.select(
        _s(F.col("o_custkey")).alias("CD_CLIENTE"),
        _s(F.col("n")).alias("QTD_CONTRATACOES_12M"),
        _money_text(F.col("cents")).alias("VLR_CONTRATACOES_12M"),
    )


def _events(spark, sf_dir, event_type: str | None = None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    if event_type is not None:
        ev = ev.filter(F.col("event_type") == event_type)
    return ev.withColumn(
        "ts_shift", F.col("ts") - F.expr(f"INTERVAL {SURVEY_SHIFT_YEARS} YEARS"))


def _nota(eid: Column) -> Column:
    """0..10 score; every 13th answer is written as '7.0' style text."""
    v = eid % 11
    return F.when(eid % 13 == 0, F.concat(_s(v), F.lit(".0"))).otherwise(_s(v))


def nps_relacional(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, "view")
    eid = F.col("event_id")
    subs = BRONZE["nps_relacional"].names[3:]
    return ev.select(
        F.date_format(F.col("ts_shift"), "yyyy-MM-dd HH:mm:ss").alias("respondedAt"),
        _s(F.col("user_id")).alias("metadata_codcliente"),
        _nota(eid).alias("resposta_NPS"),
        *[_score_text(eid, i).alias(n) for i, n in enumerate(subs)],
    )


def nps_produto(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, "purchase")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    n_parts = pa.select(F.count(F.lit(1))).scalar()
    ev = ev.withColumn("pk", F.col("event_id") % n_parts)
    df = ev.join(pa, ev.pk == pa.p_partkey, "left")
    eid = F.col("event_id")
    ts = F.col("ts_shift")
    return df.select(
        F.when(eid % 97 == 0, F.lit("bad"))
         .when(eid % 3 == 0, F.date_format(ts, "M/d/yyyy H:mm:ss a"))
         .otherwise(F.date_format(ts, "M/d/yyyy h:mm:ss a")).alias("Data da Resposta"),
        F.coalesce(F.col("p_brand"), F.lit("Sem Linha")).alias("Linha de Produto"),
        F.when(eid % 10 == 0, F.lit(None).cast("string"))
         .otherwise(_product_name(F.col("p_name"), F.col("p_partkey"))).alias("Nome do Produto"),
        _nota(eid).alias("Nota"),
        _s(F.col("user_id")).alias("Cod Cliente"),
    )


def nps_aquisicao(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, "signup")
    eid = F.col("event_id")
    subs = BRONZE["nps_transacional_aquisicao"].names[3:]
    return ev.select(
        _s(F.col("user_id")).alias("Cod Cliente"),
        F.date_format(F.col("ts_shift"), "yyyy-MM-dd").alias("Data da Resposta"),
        _nota(eid).alias("Nota NPS"),
        *[_score_text(eid, i).alias(n) for i, n in enumerate(subs)],
    )


def nps_onboarding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, "click")
    eid = F.col("event_id")
    subs = BRONZE["nps_transacional_onboarding"].names[3:]
    return ev.select(
        F.date_format(F.col("ts_shift"), "yyyy-MM-dd'T'HH:mm:ss").alias("Data de resposta"),
        _s(F.col("user_id")).alias("Cod Cliente"),
        _nota(eid).alias("Nota NPS onboarding"),
        *[_score_text(eid, i).alias(n) for i, n in enumerate(subs)],
    )


def nps_suporte(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, "error")
    eid = F.col("event_id")
    v = eid % 11
    subs = BRONZE["nps_transacional_suporte"].names[3:8]
    return ev.select(
        _s(eid).alias("ticket"),
        _nota(eid).alias("resposta_NPS"),
        F.when(v >= 9, F.lit("Promotor")).when(v >= 7, F.lit("Neutro"))
         .otherwise(F.lit("Detrator")).alias("grupo_NPS"),
        *[_score_text(eid, i).alias(n) for i, n in enumerate(subs)],
        _s(F.col("user_id")).alias("cliente"),
    )


def telemetria(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.select(
        _s(F.col("user_id")).alias("clienteid"),
        _money_text(_cents(F.col("value")), ".").alias("eventduration"),
        F.get_json_object(F.col("props"), "$.k").alias("moduloid"),
        _s(F.col("event_id") % 7).alias("productlineid"),
        F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("referencedatestart"),
        F.col("event_type").alias("statuslicenca"),
    )


BUILDERS = {
    "dados_clientes": dados_clientes,
    "contratacoes_ultimos_12_meses": contratacoes_12m,
    "historico": historico,
    "tickets": tickets,
    "telemetria": telemetria,
    "nps_relacional": nps_relacional,
    "nps_transacional_produto": nps_produto,
    "nps_transacional_aquisicao": nps_aquisicao,
    "nps_transacional_onboarding": nps_onboarding,
    "nps_transacional_suporte": nps_suporte,
}


def bronze(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The bronze extract ``entity`` as text, derived from the test tables."""
    return BUILDERS[entity](spark, sf_dir).select(*BRONZE[entity].names)


def all_bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: bronze(spark, sf_dir, name) for name in BUILDERS}
