"""The medallion as one object: bronze extracts, silver tables and gold
dimensions/facts, built lazily and each built once.

``Warehouse(spark, sf_dir)`` derives the bronze extracts from the test
tables under ``sf_dir``; ``Warehouse(spark, layers=Layers(root))`` reads
bronze text files landed under ``root/bronze`` instead.  Gold dimensions
are cut from their lineage once (the dense keys write their numbered rows;
the calendar is written explicitly because it is counted for a broadcast
decision and then joined), so facts never recompute them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starforge.plans import dims, facts
from starforge.operators import contract_span, with_row_identity
from starforge.plans.silver import SILVER_JOBS, silver_clients_raw, with_contract_span
from starforge.schemas import BRONZE, BRONZE_FILES
from starforge.session import ensure_checkpoint_dir, materialize, scratch_scope
from starforge.sources import Layers, read_csv
from starforge.sources import fixtures


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 layers: Layers | None = None, stage_silver: bool = True,
                 reads: dict[str, tuple[str, ...]] | None = None):
        """``reads``: per silver table the columns that the caller reads; a
        staged table is written with these alone, as Spark's own pruning
        stops at the written table (none named: all columns)."""
        if (sf_dir is None) == (layers is None):
            raise ValueError("give exactly one of sf_dir or layers")
        self.spark = spark
        self.sf_dir = sf_dir
        self.layers = layers
        self.stage_silver = stage_silver
        self.reads = reads or {}
        self._memo: dict[str, DataFrame] = {}
        ensure_checkpoint_dir(spark)

    def _once(self, key, build) -> DataFrame:
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    # -- bronze / silver --
    def bronze(self, entity: str) -> DataFrame:
        if self.sf_dir is not None:
            return fixtures.bronze(self.spark, self.sf_dir, entity)
        name, sep = BRONZE_FILES[entity]
        return read_csv(self.spark, f"{self.layers.bronze('')}{name}", BRONZE[entity], sep=sep)

    def silver(self, entity: str) -> DataFrame:
        """Silver table ``entity``.  With ``stage_silver`` each table is
        computed once and written to the shared scratch folder (the silver
        layer of the medallion); every consumer reads that copy with column
        pruning instead of re-deriving it."""
        source, job = SILVER_JOBS[entity]
        if not self.stage_silver:
            return job(self.bronze(source))
        if entity == "clientes":
            return with_contract_span(self.clients_raw())
        return self._once(f"silver:{entity}", lambda: materialize(
            self._read(job(self.bronze(source)), entity), f"silver_{entity}", codec="zstd"))

    def _read(self, df: DataFrame, entity: str) -> DataFrame:
        wanted = self.reads.get(entity)
        return df if wanted is None else df.select(*[c for c in df.columns if c in wanted])

    def clients_raw(self) -> DataFrame:
        """Contract rows without the per-client span (what every consumer
        but the client dimension needs)."""
        if not self.stage_silver:
            return silver_clients_raw(self.bronze("dados_clientes"))
        return self._once("silver:clientes_raw", lambda: materialize(
            self._read(silver_clients_raw(self.bronze("dados_clientes")), "clientes"), "silver_clientes",
            codec="zstd"))

    # -- gold dimensions --
    def dim_time(self) -> DataFrame:
        return self._once("dim_time", lambda: materialize(dims.dim_time(
            contract_span(self.clients_raw()), self.silver("tickets"),
            self.silver("historico"), sort=False), "dim_tempo"))

    def _sourced(self, df: DataFrame) -> DataFrame:
        """``df`` with its source-row identity when it is a staged (Parquet)
        table, so dense keys need no copy-collapsing shuffle."""
        return with_row_identity(df) if self.stage_silver else df

    def client_rows(self) -> DataFrame:
        return self._once("client_rows", lambda: dims.dim_client_keyed(
            with_contract_span(self._sourced(self.clients_raw()))))

    def dim_client(self) -> DataFrame:
        return self._once("dim_client", lambda: dims.dim_client(self.client_rows()))

    def client_map(self) -> DataFrame:
        """One surviving SK_CLIENTE per client code, written once and shared
        by every fact lookup."""
        def build():
            self.clients_raw()          # others read it too, so it is staged outside
            with scratch_scope(self.spark) as keep:
                return keep(materialize(dims.client_keys(self._client_order()), "dim_cliente_chave"))
        return self._once("client_map", build)

    def _client_order(self) -> DataFrame:
        """The numbered client rows, or (where no query step reads the rest)
        the two columns of them that the client map is made of."""
        if "client_rows" in self._memo:
            return self._memo["client_rows"]
        return dims.dim_client_keyed(
            with_contract_span(self._sourced(self.clients_raw())), keep=["CD_CLIENTE", dims.SIGNED])

    def dim_product(self) -> DataFrame:
        return self._once("dim_product", lambda: dims.dim_product(
            self.silver("historico"), self.clients_raw()))

    def dim_priority(self) -> DataFrame:
        return self._once("dim_priority", lambda: dims.dim_priority(self.silver("tickets")))

    def dim_ticket(self) -> DataFrame:
        return self._once("dim_ticket", lambda: dims.dim_ticket(self.silver("tickets")))

    # -- gold facts --
    def surveys(self, identity: bool = False) -> DataFrame:
        """The unified survey table; ``identity`` keeps each answer's
        source-row identity (used to number the survey fact)."""
        s = lambda e: (self._sourced(self.silver(e)) if identity
                       else self.silver(e))
        return facts.unified_surveys(
            s("nps_transacional_aquisicao"), s("nps_transacional_onboarding"),
            s("nps_transacional_produto"), s("nps_relacional"),
            s("nps_transacional_suporte"), self.silver("tickets"), self.dim_product())

    def fact_contracts(self) -> DataFrame:
        return facts.fact_contracts(self._sourced(self.silver("historico")),
                                    self.silver("contratacoes"),
                                    self.client_map(), self.dim_product(), self.dim_time())

    def fact_tickets(self) -> DataFrame:
        return facts.fact_tickets(self._sourced(self.silver("tickets")), self.client_map(),
                                  self.dim_priority(), self.dim_ticket(), self.dim_time())

    def fact_nps(self) -> DataFrame:
        return facts.fact_nps(self.surveys(identity=True), self.client_map(), self.dim_time())
