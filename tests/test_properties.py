"""Invariants over the sf0.001 pipeline."""
from pyspark.sql import functions as F


def test_net_plus_cost_is_revenue(pipe):
    bad = pipe.sku_profitability.where(F.col("net_profit") + F.col("total_cost") != F.col("gross_revenue"))
    assert bad.count() == 0


def test_verdicts_partition_skus_and_impacts_agree(pipe):
    d1 = pipe.sku_decisions()
    assert d1.where(~F.col("verdict").isin("DISCONTINUE", "REDUCE STOCK", "REORDER NOW", "HOLD")).count() == 0
    cat = pipe.category_impact().agg(F.sum("total_skus").alias("n"), F.sum("total_opportunity_brl").alias("o"))
    row = cat.collect()[0]
    assert row["n"] == d1.count()
    mat = pipe.strategy_matrix().agg(F.sum("total_skus")).collect()[0][0]
    assert mat == d1.count()


def test_stress_baseline_equals_profitability(pipe):
    s = {r["scenario"]: r for r in pipe.stress_summary().collect()}
    total = pipe.profitability.agg(F.sum("net_profit")).collect()[0][0]
    assert s["Baseline"]["total_net_profit"] == total
    assert s["Freight +20%"]["total_net_profit"] <= total


def test_pareto_ends_at_100(pipe):
    last = pipe.profit_pareto().orderBy(F.col("profit_rank").desc()).first()
    assert last["cumulative_profit_pct"] == "100.0%" and last["cumulative_sku_pct"] == "100.0%"


def test_monthly_units_match_gap_filled_totals(pipe):
    m = pipe.monthly_sku.join(pipe.forecastable.select("product_id"), "product_id") \
        .agg(F.sum("units_sold")).collect()[0][0]
    g = pipe.sku_series_filled.agg(F.sum("units")).collect()[0][0]
    assert m == g


def test_scorecards_have_expected_rows(pipe):
    assert pipe.inventory_scorecard().count() == 13
    v4 = pipe.confidence_scorecard()
    assert 4 <= v4.count() <= 19
    assert pipe.class_impact().count() == 3
