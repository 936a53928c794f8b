"""The medallion run: land bronze text, build silver Parquet, build and
publish gold dimensions, then gold facts -- the order the source's jobs
imply (bronze -> silver -> dimensions -> facts), each step a separate
Spark job reading the previous layer from storage.

    layers = Layers("s3a://lake/project")          # any Hadoop URI
    run_silver(spark, layers)                       # bronze CSV -> silver
    run_gold(spark, layers, jdbc=JdbcConnection(url, props))

Every step is guarded (:func:`run_step`): a failure stops the run with
the step's name.  Each gold table is computed once, written to Parquet
with its row count observed during the write, and other sinks are fed
from the written copy, so all copies hold identical keys.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.operators import ParseAudit, keep_one, new_keys, unseen, with_registered_keys, with_row_identity
from starforge.plans import dims, facts
from starforge.plans.silver import SILVER_JOBS, silver_clients_raw, with_contract_span
from starforge.schemas import BRONZE, BRONZE_FILES, GOLD_COLUMNS, SILVER, assert_schema
from starforge.session import materialize, remember_size, scratch_scope, written_size
from starforge.sinks import JdbcTarget, publish, run_step
from starforge.sinks.versioned import Version, current, read_version, write_version
from starforge.sources import Layers, read_csv, read_csv_variants, read_parquet, write_csv
from starforge.sources import fixtures

# fixed values: gold table name -> JDBC table name
GOLD_TABLES = {
    "dim_tempo": "DIM_TEMPO", "dim_cliente": "DIM_CLIENTE", "dim_produto": "DIM_PRODUTO",
    "dim_prioridade": "DIM_PRIORIDADE", "dim_ticket": "DIM_TICKET",
    "fato_contratacoes": "FATO_CONTRATACOES", "fato_tickets": "FATO_TICKETS",
    "fato_nps": "FATO_NPS",
}

# one surviving SK_CLIENTE per client code, published with the client
# dimension: facts look clients up in this client-grain table instead of
# re-aggregating the contract-row-grain dimension in every fact job
CLIENT_KEY_MAP = "dim_cliente_chave"


@dataclass
class JdbcConnection:
    """Caller-supplied connection (never hard-wired)."""
    url: str
    properties: dict = field(default_factory=dict)
    dim_mode: str = "overwrite"
    fact_mode: str = "overwrite"
    num_partitions: int | None = None       # most connections open at once per table


@dataclass
class StepReport:
    step: str
    seconds: float
    rows: int | None = None
    sinks: list = field(default_factory=list)
    input_rows: int | None = None      # facts: source rows before the inner lookups
    dropped: int | None = None         # facts: source rows the inner lookups dropped
    unread: dict | None = None         # silver: texts per column that no parser could read


def land_bronze(spark: SparkSession, sf_dir: str, layers: Layers) -> None:
    """Write the bronze extracts derived from the test tables as delimited
    text under ``layers.bronze`` (telemetry as two ``telemetria_*``
    directories, as the source lands it)."""
    for entity, (name, sep) in BRONZE_FILES.items():
        df = fixtures.bronze(spark, sf_dir, entity)
        if entity == "telemetria":
            odd = F.coalesce((F.col("productlineid").cast("int") % 2) == 1, F.lit(False))
            write_csv(df.filter(odd), layers.bronze("telemetria_a"), sep=sep)
            write_csv(df.filter(~odd), layers.bronze("telemetria_b"), sep=sep)
        else:
            write_csv(df, layers.bronze(name), sep=sep)


def read_bronze(spark: SparkSession, layers: Layers, entity: str) -> DataFrame:
    name, sep = BRONZE_FILES[entity]
    if "*" in name:         # extracts of several landings: their headers may differ
        return read_csv_variants(spark, layers.bronze(name), BRONZE[entity], sep=sep,
                                 required=[BRONZE[entity].names[0]])[0]
    return read_csv(spark, layers.bronze(name), BRONZE[entity], sep=sep)


def silver_job(spark: SparkSession, layers: Layers, entity: str) -> StepReport:
    """One bronze -> silver job: scan the extract once, parse, write."""
    with scratch_scope(spark):
        return _silver_job(spark, layers, entity)


def _silver_job(spark: SparkSession, layers: Layers, entity: str) -> StepReport:
    t0 = time.perf_counter()
    source, job = SILVER_JOBS[entity]
    audit = ParseAudit()
    bronze = read_bronze(spark, layers, source)
    if entity == "clientes":
        # the per-client span needs the rows twice: parse the text once,
        # then roll up and join back over the written copy
        raw = materialize(silver_clients_raw(bronze, audit), "silver_clientes_raw")
        out = with_contract_span(raw)
    else:
        out = job(bronze, audit=audit)
    assert_schema(out, SILVER[entity])      # analysis only: no job
    res = publish(out, layers.silver(entity))
    if not res[0].ok:
        raise RuntimeError(res[0].error)
    return StepReport(f"silver:{entity}", time.perf_counter() - t0, res[0].rows, res,
                      unread=audit.failures())


def run_concurrently(steps: list[tuple[str, object]], parallel: int) -> list[StepReport]:
    """Run independent steps, ``parallel`` at a time: each submits its own
    Spark jobs, which the scheduler runs side by side.  Reports keep the
    given order; the first failure is raised (with its step name)."""
    if parallel <= 1 or len(steps) <= 1:
        return [run_step(name, fn) for name, fn in steps]
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        futures = [pool.submit(run_step, name, fn) for name, fn in steps]
        return [f.result() for f in futures]


def run_silver(spark: SparkSession, layers: Layers, entities: list[str] | None = None,
               parallel: int = 4) -> list[StepReport]:
    """All bronze -> silver jobs (independent of each other)."""
    steps = [(f"silver:{e}", lambda e=e: silver_job(spark, layers, e))
             for e in (entities or list(SILVER_JOBS))]
    return run_concurrently(steps, parallel)


def silver(spark: SparkSession, layers: Layers, entity: str) -> DataFrame:
    return read_parquet(spark, layers.silver(entity), SILVER[entity])


def gold(spark: SparkSession, layers: Layers, table: str) -> DataFrame:
    """A gold table; its size is carried along when it still holds exactly
    the files that this process wrote, so size checks need no job."""
    df = read_parquet(spark, layers.gold(table))
    return remember_size(df, written_size(df, layers.gold(table)))


def _publish(df: DataFrame, layers: Layers, table: str, jdbc: JdbcConnection | None,
             mode: str, name: str, t0: float, parquet_mode: str = "overwrite") -> StepReport:
    if df.columns != GOLD_COLUMNS[table]:        # analysis only: no job
        raise AssertionError(f"{table}: columns {df.columns} != {GOLD_COLUMNS[table]}")
    target = None
    if jdbc is not None:
        target = JdbcTarget(jdbc.url, GOLD_TABLES[table], mode, jdbc.properties, jdbc.num_partitions)
    # the calendar is written sorted by its key (O1; per file, no global sort)
    res = publish(df, layers.gold(table), jdbc=target, parquet_mode=parquet_mode,
                  sort_within=["SK_TEMPO"] if table == "dim_tempo" else None)
    if not res[0].ok:
        raise RuntimeError(f"{table}: {res[0].error}")
    # a failed JDBC copy is reported in ``sinks`` without stopping the run
    return StepReport(name, time.perf_counter() - t0, res[0].rows, res)


SURVEY_ENTITIES = ("nps_relacional", "nps_transacional_produto", "nps_transacional_aquisicao",
                   "nps_transacional_onboarding")


def calendar_extra_dates(spark: SparkSession, layers: Layers) -> list:
    """Dates the source's calendar leaves out (survey answers, ticket
    updates), for a calendar that covers every fact date."""
    extra = [(silver(spark, layers, e), "dt_resposta") for e in SURVEY_ENTITIES]
    return extra + [(silver(spark, layers, "tickets"), "dt_atualizacao")]


DIM_BUILDERS = {
    "dim_tempo": lambda s, l, all_dates=False: dims.dim_time(
        silver(s, l, "clientes"), silver(s, l, "tickets"), silver(s, l, "historico"),
        extra_dates=calendar_extra_dates(s, l) if all_dates else None, sort=False),
    "dim_cliente": lambda s, l: dims.dim_client_keyed(with_row_identity(silver(s, l, "clientes"))),
    "dim_produto": lambda s, l: dims.dim_product(silver(s, l, "historico"),
                                                 silver(s, l, "clientes")),
    "dim_prioridade": lambda s, l: dims.dim_priority(silver(s, l, "tickets")),
    "dim_ticket": lambda s, l: dims.dim_ticket(silver(s, l, "tickets")),
}


def dim_job(spark: SparkSession, layers: Layers, table: str,
            jdbc: JdbcConnection | None = None, calendar_all_dates: bool = False,
            parquet_mode: str = "overwrite") -> StepReport:
    """One dimension.  ``calendar_all_dates`` makes the calendar cover the
    survey and ticket-update dates too (the source's calendar does not, so
    facts on those dates are dropped by the inner calendar lookups).
    ``parquet_mode="append"`` adds this run's rows to the stored dimension;
    the client key map always holds the keys of the last run."""
    with scratch_scope(spark):
        return _dim_job(spark, layers, table, jdbc, calendar_all_dates, parquet_mode)


def _dim_job(spark, layers, table, jdbc, calendar_all_dates, parquet_mode) -> StepReport:
    t0 = time.perf_counter()
    build = DIM_BUILDERS[table]
    df = build(spark, layers, calendar_all_dates) if table == "dim_tempo" else build(spark, layers)
    rows = dims.dim_client(df) if table == "dim_cliente" else df
    report = _publish(rows, layers, table, jdbc, jdbc.dim_mode if jdbc else "overwrite",
                      f"gold:{table}", t0, parquet_mode)
    if table == "dim_cliente":
        report.sinks += publish(dims.client_keys(df), layers.gold(CLIENT_KEY_MAP))
        report.seconds = time.perf_counter() - t0
    return report


# the columns that identify a row of a dimension; a contract row is all of its columns
NATURAL_KEYS = {
    "dim_cliente": ("SK_CLIENTE", GOLD_COLUMNS["dim_cliente"][1:], "bigint"),
    "dim_produto": ("SK_PRODUTO", ["CD_PRODUTO"], "int"),
    "dim_prioridade": ("SK_PRIORIDADE", ["TIPO_PRIORIDADE"], "int"),
    "dim_ticket": ("sk_ticket", ["tipo_ticket", "status_ticket"], "int"),
}


def extend_dim(rows: DataFrame, path: str, name: str, natural: list[str], key_type: str = "bigint") -> Version:
    """Append to the dimension at ``path`` (a versioned table) the rows whose
    natural key it lacks, one each, under keys that last.

    The keys live in a registry beside it (``<path>_chaves``), committed first:
    if the run dies between the two commits, the next one finds the keys and
    appends the same rows under them."""
    spark = rows.sparkSession
    registry_path = f"{path.rstrip('/')}_chaves"
    known = current(spark, registry_path)
    registry = read_version(spark, registry_path, known) if known else None
    rows = rows.select(*[c for c in rows.columns if c != name])
    write_version(new_keys(rows, registry, name, natural, key_type), registry_path, "append")
    registry = read_version(spark, registry_path)
    stored = current(spark, path)
    if stored is not None:
        rows = unseen(rows, read_version(spark, path, stored), natural)
    return write_version(with_registered_keys(keep_one(rows, natural), registry, name, natural), path, "append")


def extend_dim_job(spark: SparkSession, layers: Layers, table: str) -> StepReport:
    """One incremental dimension run into ``<table>_incremental``: rows already
    stored keep their keys, new ones are numbered on."""
    t0 = time.perf_counter()
    name, natural, key_type = NATURAL_KEYS[table]
    with scratch_scope(spark):
        df = DIM_BUILDERS[table](spark, layers)
        rows = dims.dim_client(df) if table == "dim_cliente" else df
        version = extend_dim(rows, layers.gold(f"{table}_incremental"), name, natural, key_type)
    return StepReport(f"gold:{table}", time.perf_counter() - t0, version.rows)


def _fact_df(spark: SparkSession, layers: Layers, table: str) -> DataFrame:
    s = lambda e: silver(spark, layers, e)
    # fact rows carry their silver source-row identity (final tie-breaker
    # of the fact key, so numbering needs no copy-collapsing shuffle)
    r = lambda e: with_row_identity(s(e))
    g = lambda t: gold(spark, layers, t)
    clients = g(CLIENT_KEY_MAP)
    if table == "fato_contratacoes":
        return facts.fact_contracts(r("historico"), s("contratacoes"), clients,
                                    g("dim_produto"), g("dim_tempo"))
    if table == "fato_tickets":
        return facts.fact_tickets(r("tickets"), clients, g("dim_prioridade"),
                                  g("dim_ticket"), g("dim_tempo"))
    if table == "fato_nps":
        surveys = facts.unified_surveys(
            r("nps_transacional_aquisicao"), r("nps_transacional_onboarding"),
            r("nps_transacional_produto"), r("nps_relacional"), r("nps_transacional_suporte"),
            s("tickets"), g("dim_produto"))
        return facts.fact_nps(surveys, clients, g("dim_tempo"))
    raise KeyError(table)


# silver sources of each fact's rows (the survey fact's support answers are
# dated through their ticket, one date per ticket, so they never multiply)
FACT_SOURCES = {
    "fato_contratacoes": ["historico"],
    "fato_tickets": ["tickets"],
    "fato_nps": ["nps_transacional_aquisicao", "nps_transacional_onboarding",
                 "nps_transacional_produto", "nps_relacional", "nps_transacional_suporte"],
}


def fact_job(spark: SparkSession, layers: Layers, table: str,
             jdbc: JdbcConnection | None = None) -> StepReport:
    """One fact.  The report carries the source row count and how many of
    those rows the inner lookups dropped (no extra job: both counts were
    observed while the silver and fact tables were written)."""
    with scratch_scope(spark):
        return _fact_job(spark, layers, table, jdbc)


def _fact_job(spark, layers, table, jdbc) -> StepReport:
    t0 = time.perf_counter()
    df = _fact_df(spark, layers, table)
    report = _publish(df, layers, table, jdbc, jdbc.fact_mode if jdbc else "overwrite",
                      f"gold:{table}", t0)
    inputs = [written_size(silver(spark, layers, e), layers.silver(e)) for e in FACT_SOURCES[table]]
    if report.rows is not None and all(s is not None for s in inputs):
        report.input_rows = sum(s.rows for s in inputs)
        report.dropped = report.input_rows - report.rows
    return report


def run_gold(spark: SparkSession, layers: Layers, jdbc: JdbcConnection | None = None,
             calendar_all_dates: bool = False, parallel: int = 4) -> list[StepReport]:
    """All dimensions (independent of each other), then all facts (each
    reads the published dimensions)."""
    out = run_concurrently([(f"gold:{t}", lambda t=t: dim_job(spark, layers, t, jdbc,
                                                          calendar_all_dates))
                       for t in DIM_BUILDERS], parallel)
    out += run_concurrently([(f"gold:{t}", lambda t=t: fact_job(spark, layers, t, jdbc))
                        for t in ("fato_contratacoes", "fato_tickets", "fato_nps")], parallel)
    return out


def run_all(spark: SparkSession, sf_dir: str, layers: Layers,
            jdbc: JdbcConnection | None = None) -> list[StepReport]:
    """Land the test extracts, then run the whole medallion."""
    t0 = time.perf_counter()
    run_step("land", lambda: land_bronze(spark, sf_dir, layers))
    reports = [StepReport("land", time.perf_counter() - t0)]
    reports += run_silver(spark, layers)
    reports += run_gold(spark, layers, jdbc)
    return reports
