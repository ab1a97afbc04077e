"""The layer tables of one source folder, each built on first use and then read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import dq, finance, mining, retail
from tessera.sources import finance as fin_source
from tessera.sources import retail as retail_source
from tessera.sources.workspace import materialize, new_path, sized, spread

RETAIL_LAYERS = {
    "bronze": "bronze_sales_raw", "silver": "silver_sales", "gold_fact": "gold_fact_sales",
    "gold_dim_customer": "gold_dim_customer", "gold_dim_product": "gold_dim_product",
    "gold_dim_store": "gold_dim_store", "gold_dim_date": "gold_dim_date",
}
FINANCE_LAYERS = {
    "bronze_concur": "fin_src_concur_expenses", "bronze_card": "fin_src_corporate_card",
    "silver": "fin_slv_transactions", "gold_spend": "fin_gld_spend_by_dept_month",
    "gold_vendors": "fin_gld_top_vendors", "departments": "fin_dim_department",
    "employees": "fin_dim_employee", "vendors": "fin_dim_vendor",
}
RETAIL_DIMS = ("gold_dim_customer", "gold_dim_product", "gold_dim_store", "gold_dim_date")
# What a refresh starts from.
SOURCE_LAYERS = (
    "bronze_sales_raw", *RETAIL_DIMS, "fin_src_concur_expenses", "fin_dim_department", "fin_dim_employee", "fin_dim_vendor",
)
# The refresh stamps its events with this time; a scheduled job passes its own.
RUN_AT = "2026-04-21 00:00:00"
# The day that customers' behaviour is judged on, for models that all reports share.
AS_OF = "2001-08-01"


class Warehouse:
    """Model tables over the parquet files in ``source_dir``.

    ``table(name)`` builds what the table needs, writes it below the shared folder and
    returns the written table, so later queries read columns instead of redoing the refresh.
    """

    def __init__(
        self, spark: SparkSession, source_dir: str, run_at: str = RUN_AT, as_of: str = AS_OF, sources: Warehouse | None = None
    ) -> None:
        self.spark = spark
        self.source_dir = source_dir
        self.run_at = run_at
        self.as_of = as_of
        self._sources = sources
        self._tables: dict[str, DataFrame] = {}
        self._folders: dict[str, str] = {}
        self._clusters: mining.Clusters | None = None

    def source(self, name: str) -> DataFrame:
        return retail_source.read(self.spark, self.source_dir, name)

    def dims(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in RETAIL_DIMS}

    def table(self, name: str) -> DataFrame:
        if name in _VIEWS:
            return _VIEWS[name](self)
        if self._sources is not None and name in SOURCE_LAYERS:
            return self._sources.table(name)
        if name not in self._tables:
            build, partition_by = _BUILDERS[name]
            folder = new_path(self.spark, name)
            table = materialize(build(self), name, partition_by, folder, _COMPACT | _OPTIONS.get(name, {}))
            self._tables[name] = sized(table) if name in _JOINED else table
            self._folders[name] = folder
        return self._tables[name]

    def folder(self, name: str) -> str:
        """Where a written table lies."""
        if self._sources is not None and name in SOURCE_LAYERS:
            return self._sources.folder(name)
        self.table(name)
        return self._folders[name]

    def clusters(self) -> mining.Clusters:
        """Customer clusters, fitted once for all their reports."""
        if self._clusters is None:
            features = mining.customer_features(self.table("gold_dim_customer"), self.table("gold_fact_sales"), self.as_of)
            self._clusters = mining.cluster_customers(features)
        return self._clusters

    def replayed(self) -> Warehouse:
        """A second warehouse over the same feeds and dimensions, its derived layers still to build.

        Feeds and dimensions are built here on first use, so a replay of one area leaves those of the other alone.
        """
        return Warehouse(self.spark, self.source_dir, self.run_at, self.as_of, sources=self)

    def register_views(self, sql: str | None = None) -> None:
        """Tables as temporary views for ad-hoc SQL: all, or those whose name occurs in ``sql``."""
        for name in [*_BUILDERS, *_VIEWS]:
            if name not in MODELS and (sql is None or name.lower() in sql.lower()):
                self.table(name).createOrReplaceTempView(name)


def _bronze(w: Warehouse) -> DataFrame:
    lineitem = spread(retail_source.order_lines(w.source("lineitem")))
    return retail_source.bronze_sales(retail_source.sales(lineitem, w.source("orders")))


def _events(w: Warehouse) -> DataFrame:
    at = F.lit(w.run_at)
    silver = dq.dq_events(retail.silver_counts(w.table("silver_staged")), dq.SILVER_EVENTS, at, 1)
    gold = dq.dq_events(retail.gold_counts(w.table("gold_staged")), dq.GOLD_EVENTS, at, 11)
    fin = dq.dq_events(finance.silver_counts(w.table("fin_staged")), dq.FINANCE_EVENTS, at, 21)
    return silver.unionByName(gold).unionByName(fin)


_Builder = Callable[[Warehouse], DataFrame]
_BUILDERS: dict[str, tuple[_Builder, tuple[str, ...]]] = {
    "bronze_sales_raw": (_bronze, ()),
    "silver_staged": (lambda w: retail.stage_silver(w.table("bronze_sales_raw")), ("status",)),
    "gold_staged": (lambda w: retail.gold_by_date(w.table("silver_sales"), w.dims()), ("status",)),
    "gold_dim_customer": (
        lambda w: retail_source.dim_customer(w.source("customer"), w.source("nation"), w.source("region")), ()),
    "gold_dim_product": (lambda w: retail_source.dim_product(w.source("part")), ()),
    "gold_dim_store": (
        lambda w: retail_source.dim_store(w.source("supplier"), w.source("nation"), w.source("region")), ()),
    "gold_dim_date": (lambda w: retail_source.dim_date(w.source("orders")), ()),
    "fin_src_concur_expenses": (lambda w: fin_source.expense_claims(w.source("orders"), w.source("lineitem")), ()),
    "fin_dim_department": (lambda w: fin_source.departments(w.source("customer")), ()),
    "fin_dim_employee": (lambda w: fin_source.employees(w.source("customer")), ()),
    "fin_dim_vendor": (lambda w: fin_source.vendors(w.source("supplier"), w.source("nation")), ()),
    "fin_vendor_map": (
        lambda w: finance.vendor_map(
            w.table("fin_src_concur_expenses"), w.table("fin_src_corporate_card"), w.table("fin_dim_vendor")), ()),
    "fin_staged": (
        lambda w: finance.cluster_by_date(finance.stage_silver(
            spread(w.table("fin_src_concur_expenses")), spread(w.table("fin_src_corporate_card")),
            w.table("fin_vendor_map"), w.table("fin_dim_employee"))), ("status",)),
    "fin_gld_spend_by_dept_month": (
        lambda w: finance.spend_by_dept_month(w.table("fin_slv_transactions"), w.table("fin_dim_department")), ()),
    "fin_gld_top_vendors": (
        lambda w: finance.top_vendors(
            finance.vendor_totals(w.table("fin_slv_transactions"), w.table("fin_dim_vendor"))), ()),
    "oltp_transactions": (lambda w: retail_source.by_key(retail_source.oltp_transactions(w.source("orders")), "txn_id"), ()),
    "data_quality_events": (_events, ()),
    "fraud_scores": (lambda w: mining.fraud_scores(w.table("banking_transactions")), ()),
    "cluster_points": (lambda w: w.clusters().points, ()),
    "cluster_centroids": (lambda w: w.clusters().centroids, ()),
    "spend_scores": (lambda w: mining.spend_scores(w.table("fin_slv_transactions"), w.table("fin_dim_department")), ()),
}
# Layers are read more often than written, and their texts repeat: a third less to write than by the default codec.
_COMPACT = {"compression": "zstd"}
# Point reads: the key is sorted, and a bloom filter per row group tells whether a key can be there at all.
_OPTIONS = {"oltp_transactions": {"parquet.bloom.filter.enabled#txn_id": "true"}}
# Tables that others look their keys up in, and that grow with the input.
_JOINED = ("gold_dim_customer", "gold_dim_product", "gold_dim_store", "fin_dim_employee", "fin_dim_vendor", "fin_vendor_map")
# Model outputs: written on first use like layers, but no tables for ad-hoc SQL.
MODELS = ("fraud_scores", "spend_scores", "cluster_points", "cluster_centroids")
# Plain projections of a written or given table; not written again.
_VIEWS: dict[str, _Builder] = {
    "silver_sales": lambda w: retail.silver_of(w.table("silver_staged")),
    "gold_fact_sales": lambda w: retail.fact_of(w.table("gold_staged")),
    "fin_slv_transactions": lambda w: finance.silver_of(w.table("fin_staged")),
    "banking_transactions": lambda w: retail_source.banking_transactions(w.source("events")),
    "fin_src_corporate_card": lambda w: fin_source.corporate_card(w.source("events")),
}

_OPEN: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, source_dir: str) -> Warehouse:
    """The warehouse of a folder, shared by the queries of one Spark application."""
    key = (spark.sparkContext.applicationId, source_dir)
    if key not in _OPEN or _OPEN[key].spark is not spark:
        _OPEN[key] = Warehouse(spark, source_dir)
    return _OPEN[key]
