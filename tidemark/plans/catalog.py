"""The warehouse models over one test-data folder, built lazily.

``Models(spark, sf_dir)`` derives the raw layer from ``events`` (fixed
``_loaded_at`` rule) and exposes every model as a DataFrame. Nothing is
collected; each property is a plan Spark runs when the caller acts on it.

With ``materialize=True`` the shared intermediates (raw tables, staging,
history, dimensions, fact) are written once as reliable checkpoints in the
session's ``spark.checkpoint.dir``, so queries that use the fact several
times (the check suite, scalar-subquery reports) neither recompute it nor
keep a long lineage to replay after a lost executor.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import WarehouseConfig
from tidemark.operators import dims, facts, history, marts, staging
from tidemark.session import checkpoint_root, configure
from tidemark.sources import fixtures


class Models:
    def __init__(self, spark: SparkSession, sf_dir: str, seeded: bool = False,
                 strategy: str = "auto", cfg: WarehouseConfig | None = None,
                 materialize: bool = False):
        self.spark = configure(spark)
        self.materialize = materialize
        if materialize:
            checkpoint_root(self.spark)  # the shared folder (a private one only if unset)
        self.sf_dir = sf_dir.rstrip("/")
        self.seeded = seeded
        self.strategy = strategy
        self.cfg = cfg or WarehouseConfig(root="unused")

    def _keep(self, df: DataFrame) -> DataFrame:
        return df.checkpoint(eager=True) if self.materialize else df

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return {k: self._keep(v) for k, v in fixtures.raw_tables(self.events, self.seeded).items()}

    @property
    def raw_orders(self) -> DataFrame:
        return self.raw["orders"]

    @cached_property
    def stg_orders(self) -> DataFrame:
        return self._keep(staging.stg_orders(self.raw_orders))

    @cached_property
    def snap_customers(self) -> DataFrame:
        return self._keep(history.bulk_history(self.raw["customers"], "customers"))

    @cached_property
    def snap_restaurants(self) -> DataFrame:
        return self._keep(history.bulk_history(self.raw["restaurants"], "restaurants"))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._keep(dims.dim_customer(self.snap_customers))

    @cached_property
    def dim_restaurant(self) -> DataFrame:
        return self._keep(dims.dim_restaurant(self.snap_restaurants))

    @cached_property
    def fct_orders(self) -> DataFrame:
        return self._keep(facts.fact_rows(self.stg_orders, self.dim_customer, self.dim_restaurant,
                                          strategy=self.strategy,
                                          max_bytes=self.cfg.broadcast_max_bytes))

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date_covering(self.stg_orders, "order_date")

    @cached_property
    def agg_daily_zone_metrics(self) -> DataFrame:
        return marts.agg_daily_zone_metrics(self.fct_orders)

    @cached_property
    def agg_monthly_revenue_by_tier(self) -> DataFrame:
        return marts.agg_monthly_revenue_by_tier(self.fct_orders)
