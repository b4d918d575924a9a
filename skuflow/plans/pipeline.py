"""Pipeline: wires the operators in dependency order and decides persistence.

Each stage is a lazily built DataFrame. Stages read by many later stages
(the (SKU, month) base, F7b, F8, the filled series, the forecast table and D1)
are written as parquet to the shared folder of ``spark.checkpoint.dir`` and
read back (``store='memory'`` caches them instead). Building a stage therefore
runs jobs; a global rank runs one for the bounds of its value ranges.

The quality gate stands in front of every stage: the cleaned tables are handed
on only if every translated category has its cost rows.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.functions.ranking import By, global_rank

from skuflow.operators import clean, demand, features, forecast, forecast_reports, inventory, kpi, profit, quality, renew, trust
from skuflow.params import Params
from skuflow.session import delete_stages, materialize, materialize_each
from skuflow.sources import load, testdata


class Pipeline:
    """``store``: how shared stages are kept. 'parquet' (default) writes each
    to the shared checkpoint folder and reads it back: the lineage is cut (plans
    stay small, a lost executor never forces a recompute from the raw tables)
    and the planner sees real file sizes. 'memory' persists in the cache; 'none'
    keeps everything lazy. ``stored_tables``: the cleaned tables are first written in
    buckets of their join keys (`sources.load`), so joins on them move no rows and the
    column counts of the report come from that write. ``quarantine``: records that a
    checked load set aside, for the report."""

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], params: Params | None = None,
                 store: str = "parquet", gate: bool = True, forecaster: str = "holt_winters",
                 stored_tables: bool = False, quarantine: DataFrame | None = None):
        self.spark = spark
        self.raw = raw
        self.params = params or Params()
        self.store = store
        self.gate = gate
        self.forecaster = forecaster
        self.stored_tables = stored_tables
        self.quarantine = quarantine
        if forecaster not in ("holt_winters", "moving_average"):
            raise ValueError(f"no forecaster {forecaster}")
        self._persisted: list[DataFrame] = []
        self._written: list[str] = []
        self._run_id = uuid.uuid4().hex[:12]

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, dirty: bool = False, **kw) -> Pipeline:
        return cls(spark, testdata.load_tables(spark, sf_dir, dirty=dirty), **kw)

    @classmethod
    def from_demand_series(cls, spark: SparkSession, series: DataFrame, **kw) -> Pipeline:
        """Forecasting alone, from an external (product_id, category, order_month,
        units_sold) series: M1-M22 that need no money. Other stages have no tables."""
        out = cls(spark, {}, gate=False, **kw)
        out.__dict__["monthly_sku"] = series
        return out

    @classmethod
    def from_forecasts(cls, spark: SparkSession, raw: dict[str, DataFrame], forecasts: DataFrame, **kw) -> Pipeline:
        """The whole pipeline on a stored forecast table (S4) instead of a fit of its own."""
        out = cls(spark, raw, **kw)
        out.__dict__["forecasts"] = forecasts
        return out

    def _keep(self, df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
        if self.store == "parquet":
            return materialize(df, f"{self._run_id}-{name}", self._written, by)
        if self.store == "memory":
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._persisted.append(df)
        return df

    def release(self) -> None:
        """Free cached stages and delete stored ones; DataFrames of this pipeline end with it."""
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()
        delete_stages(self.spark, self._written)
        if "stored" in self.__dict__:
            self.stored.release()

    # ---- cleaning and quality ------------------------------------------------
    @cached_property
    def stored(self) -> load.Stored:
        """The cleaned tables as written (``stored_tables``), with the counts taken meanwhile."""
        return load.store_tables(self.spark, self.raw)

    @cached_property
    def cleaned(self) -> dict[str, DataFrame]:
        """C1-C5 before the gate: what the reports look at."""
        return self.stored.tables if self.stored_tables else clean.clean_tables(self.raw)

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        """The cleaned tables, once they have passed the gate: every stage reads these."""
        if self.gate and self._dims["coverage"] > 0:
            raise quality.DataQualityError(f"data-quality gate failed: cost_coverage_missing={self._dims['coverage']}")
        return self.cleaned

    def quality_report(self) -> DataFrame:
        return quality.quality_report(self.cleaned, self.stored if self.stored_tables else None, self.quarantine)

    def load_report(self) -> DataFrame:
        """Rows, nulls and cleaned values per stored table."""
        return self.stored.load_report()

    def key_report(self) -> DataFrame:
        return quality.key_report({**self.cleaned, "forecast_results": self.forecasts})

    @cached_property
    def _dims(self) -> dict[str, int]:
        """One small job: the Q6 gate and the size bound of the category dimension."""
        return quality.dimension_check(self.cleaned, self.params.broadcast_max_rows)

    @cached_property
    def small_dims(self) -> bool:
        """Proven bound: every category table within the cap and the cost tables
        free of duplicate keys, so no join among them can grow past the cap."""
        d, cap = self._dims, self.params.broadcast_max_rows
        names = ["category_translation", "supplier_costs", "storage_costs", "fulfillment_costs", "return_costs"]
        return all(d[f"rows:{n}"] <= cap for n in names) and all(d[f"dups:{n}"] == 0 for n in names[1:])

    # ---- F -------------------------------------------------------------------
    @cached_property
    def dim_category(self) -> DataFrame:
        return features.dim_category(self.tables, self.params.broadcast_max_rows, self.small_dims)

    def dim_date(self) -> DataFrame:
        return features.dim_date(self.tables["orders"])

    def dim_product(self) -> DataFrame:
        t = self.tables
        return features.dim_product(t["products"], t["category_translation"], self.params.broadcast_max_rows,
                                    self.small_dims)

    def fact_order_items(self) -> DataFrame:
        t = self.tables
        return features.fact_order_items(t["order_items"], t["orders"], t["order_reviews"],
                                         self.params.excluded_statuses)

    @cached_property
    def product_category(self) -> DataFrame:
        t = self.tables
        return features.product_category(t["products"], t["category_translation"],
                                         self.params.broadcast_max_rows, self.small_dims)

    @cached_property
    def base(self) -> DataFrame:
        t = self.tables
        return self._keep(features.sku_month_base(t["order_items"], t["orders"], t["order_reviews"],
                                                  self.params.excluded_statuses), "base")

    @cached_property
    def sku_revenue(self) -> DataFrame:
        return features.sku_revenue(self.base)

    @cached_property
    def sku_costs(self) -> DataFrame:
        return features.sku_costs(self.sku_revenue, self.product_category, self.dim_category,
                                  self.params.broadcast_max_rows, self.small_dims)

    @cached_property
    def sku_reviews(self) -> DataFrame:
        return features.sku_reviews(self.base)

    @cached_property
    def profitability(self) -> DataFrame:
        """F7b without the rank column (what every downstream operator reads)."""
        return self._keep(features.sku_profitability(self.sku_revenue, self.sku_costs, self.sku_reviews,
                                                     ranked=False, extras=True), "profitability")

    @cached_property
    def sku_profitability(self) -> DataFrame:
        """F7b with sku_rank (a global rank over value ranges)."""
        order = [By("gross_revenue", desc=True), By("product_id")]
        return global_rank(self.profitability.select(*features.PROFIT_COLUMNS), order, "sku_rank")

    @cached_property
    def classification(self) -> DataFrame:
        """F7c without the rank column."""
        return features.sku_class(self.profitability)

    @cached_property
    def sku_class(self) -> DataFrame:
        """F7c with sku_rank."""
        return features.sku_class(self.sku_profitability)

    @cached_property
    def monthly_sku(self) -> DataFrame:
        return self._keep(features.monthly_sku(self.base, self.product_category), "monthly_sku")

    # ---- P -------------------------------------------------------------------
    def class_impact(self) -> DataFrame:
        return profit.class_impact(self.classification)

    def profit_pareto(self) -> DataFrame:
        return profit.profit_pareto(self.profitability, self.params.currency)

    def loss_leaders(self, n: int = 50) -> DataFrame:
        return profit.loss_leaders(self.profitability, self.sku_costs, n, self.params.currency)

    def category_margin_drift(self) -> DataFrame:
        return profit.category_margin_drift(self.base, self.product_category, self.tables["supplier_costs"],
                                            self.params.split_month, self.params.broadcast_max_rows,
                                            self.small_dims)

    def stress_freight(self) -> DataFrame:
        return profit.stress(self.sku_revenue, self.sku_costs, profit.SCENARIOS[1][1], with_total_cost=True)

    def stress_returns(self) -> DataFrame:
        return profit.stress(self.sku_revenue, self.sku_costs, profit.SCENARIOS[2][1])

    def stress_storage(self) -> DataFrame:
        return profit.stress(self.sku_revenue, self.sku_costs, profit.SCENARIOS[3][1])

    def stress_summary(self) -> DataFrame:
        return profit.stress_summary(self.sku_revenue, self.sku_costs)

    # ---- K -------------------------------------------------------------------
    def portfolio_kpis(self) -> DataFrame:
        return kpi.portfolio_kpis(self.classification)

    def monthly_revenue(self) -> DataFrame:
        t = self.tables
        return kpi.monthly_revenue(t["order_items"], t["orders"], self.params.excluded_statuses)

    def top_skus(self, n: int = 400) -> DataFrame:
        return kpi.top_skus(self.classification, n)

    def top_products(self) -> DataFrame:
        t = self.tables
        return kpi.top_products(t["order_items"], t["products"])

    def worst_rated(self, n: int = 5) -> DataFrame:
        t = self.tables
        return kpi.worst_rated(t["order_items"], t["orders"], t["order_reviews"], t["products"], n)

    # ---- M (demand) ------------------------------------------------------------
    @cached_property
    def demand_features(self) -> DataFrame:
        return self._keep(demand.demand_features(self.monthly_sku), "demand_features")

    def history_coverage(self) -> DataFrame:
        return demand.history_coverage(self.monthly_sku)

    @cached_property
    def forecastable(self) -> DataFrame:
        return demand.forecastable(self.demand_features, self.params.forecast)

    @cached_property
    def filled_series(self) -> DataFrame:
        """M4 for both grains (eligible SKUs, M3, and all categories), materialised:
        every forecaster, backtest and chart-data view reads it."""
        sku = demand.sku_filled(self.monthly_sku, self.params.forecast)
        category = demand.category_filled(self.monthly_sku, self.params.forecast)
        if self.store == "parquet":
            return materialize_each({"sku": sku, "category": category}, "grain", f"{self._run_id}-filled_series", self._written)
        return self._keep(sku.unionByName(category), "filled_series")

    @cached_property
    def sku_series_filled(self) -> DataFrame:
        return self.filled_series.where(F.col("grain") == "sku")

    @cached_property
    def category_series_filled(self) -> DataFrame:
        return self.filled_series.where(F.col("grain") == "category")

    def gap_filled_series(self) -> DataFrame:
        return self.filled_series

    def baselines(self) -> DataFrame:
        return demand.baselines(self.sku_series_filled, self.params.forecast)

    @cached_property
    def fits(self) -> DataFrame:
        """The Holt-Winters fit of every series, stored once: the forecast table and the
        chart segments are read from it."""
        return self._keep(forecast.fit_series(self.filled_series, self.params.forecast), "fits", ("grain", "segment"))

    @cached_property
    def forecasts(self) -> DataFrame:
        """The forecast table, stored by grain: readers of one grain skip the other's files."""
        if self.forecaster == "holt_winters":
            rows = forecast.forecast_rows(self.fits)
        else:
            rows = demand.moving_average_forecast(self.filled_series, self.params.forecast)
        return self._keep(rows, "forecasts", ("grain",))

    def renew_forecasts(self, path: str) -> renew.Renewal:
        """Bring the forecast store at ``path`` up to date: only changed series are fitted."""
        p = self.params.forecast
        fit = forecast.holt_winters if self.forecaster == "holt_winters" else demand.moving_average_forecast
        return renew.renew_forecasts(self.filled_series, path, lambda series: fit(series, p), self.forecaster, p)

    def forecast_table(self) -> DataFrame:
        return self.forecasts

    # ---- D -------------------------------------------------------------------
    @cached_property
    def decisions(self) -> DataFrame:
        return self._keep(inventory.sku_decisions(self.forecasts, self.demand_features, self.profitability,
                                                  self.params.inventory), "decisions")

    def sku_decisions(self) -> DataFrame:
        return self.decisions

    def category_decisions(self) -> DataFrame:
        return inventory.category_decisions(self.forecasts, self.monthly_sku, self.profitability,
                                            self.params.inventory)

    def demand_trend(self) -> DataFrame:
        return inventory.demand_trend(self.decisions)

    def stockout_register(self) -> DataFrame:
        return inventory.stockout_register(self.decisions, self.params.inventory)

    def action_list(self) -> DataFrame:
        return inventory.action_list(self.decisions)

    def margin_review_quadrant(self) -> DataFrame:
        return inventory.margin_review_quadrant(self.profitability, self.decisions, self.params.currency)

    def strategy_vs_ops(self) -> DataFrame:
        return inventory.strategy_vs_ops(self.classification, self.decisions)

    def strategy_matrix(self) -> DataFrame:
        return inventory.strategy_matrix(self.classification, self.decisions)

    def action_sheet(self) -> DataFrame:
        return inventory.action_sheet(self.decisions, self.sku_class, self.sku_revenue)

    def sku_snapshot(self) -> DataFrame:
        return inventory.sku_snapshot(self.decisions, self.sku_class, self.sku_revenue)

    def monthly_economics(self) -> DataFrame:
        return inventory.monthly_economics(self.monthly_sku, self.decisions)

    def verdict_impact(self) -> DataFrame:
        return inventory.verdict_impact(self.decisions, self.params.currency)

    def category_impact(self) -> DataFrame:
        return inventory.category_impact(self.decisions)

    def inventory_scorecard(self) -> DataFrame:
        return inventory.inventory_scorecard(self.decisions, self.forecasts, self.params.currency)

    # ---- K2, V -----------------------------------------------------------------
    def category_accuracy(self) -> DataFrame:
        return trust.category_accuracy(self.forecasts)

    def reliability_by_band(self) -> DataFrame:
        return trust.reliability_by_band(self.decisions, self.profitability)

    def model_comparison(self, live_baselines: bool = False) -> DataFrame:
        return trust.model_comparison(self.forecasts, self.baselines() if live_baselines else None)

    def model_comparison_live(self) -> DataFrame:
        return self.model_comparison(live_baselines=True)

    def confidence_scorecard(self) -> DataFrame:
        return trust.confidence_scorecard(self.forecasts, self.decisions, self.params.trust_currency)

    def confidence_coverage(self) -> DataFrame:
        return trust.confidence_coverage(self.forecasts)

    # ---- forecast review and chart data -----------------------------------------
    def forecast_review(self) -> DataFrame:
        return forecast_reports.forecast_review(self.forecasts)

    def sku_forecast_preview(self) -> DataFrame:
        return forecast_reports.sku_forecast_preview(self.forecasts)

    @cached_property
    def sku_metrics(self) -> DataFrame:
        return forecast_reports.sku_metrics(self.forecasts)

    def sku_metrics_table(self) -> DataFrame:
        return self.sku_metrics

    def feature_sku(self) -> DataFrame:
        return forecast_reports.feature_sku(self.sku_metrics)

    def forecast_vs_actual(self) -> DataFrame:
        if self.forecaster == "holt_winters":
            return forecast.segment_rows(self.sku_series_filled, self.fits.where(F.col("grain") == "sku"), self.params.forecast)
        return forecast_reports.moving_average_segments(self.sku_series_filled, self.params.forecast)

    def mape_histogram(self) -> DataFrame:
        return forecast_reports.mape_histogram(self.spark, self.sku_metrics)

    def mape_summary(self) -> DataFrame:
        return forecast_reports.mape_summary(self.sku_metrics)

    @cached_property
    def sku_units(self) -> DataFrame:
        return forecast_reports.sku_units(self.monthly_sku)

    def coverage_pareto(self) -> DataFrame:
        return forecast_reports.coverage_pareto(self.sku_units, self.sku_metrics)

    def coverage_summary(self) -> DataFrame:
        return forecast_reports.coverage_summary(self.sku_units, self.sku_metrics)

    def accuracy_by_volume(self) -> DataFrame:
        return forecast_reports.accuracy_by_volume(self.sku_units, self.sku_metrics)

    def category_bias(self, forecast_skus_only: bool = False) -> DataFrame:
        return forecast_reports.category_bias(self.monthly_sku, self.forecasts, forecast_skus_only)

    def category_bias_of_forecast_skus(self) -> DataFrame:
        return self.category_bias(forecast_skus_only=True)

    # ---- cleaned tables (C1-C4) --------------------------------------------------
    def clean_orders(self) -> DataFrame:
        return self.cleaned["orders"]

    def clean_items(self) -> DataFrame:
        return self.cleaned["order_items"]

    def clean_products(self) -> DataFrame:
        return self.cleaned["products"]

    def clean_supplier_costs(self) -> DataFrame:
        return self.cleaned["supplier_costs"]
