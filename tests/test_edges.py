"""Branches the driver data does not reach (FIXTURES.md section 4), on literal frames."""
from decimal import Decimal as D

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from skuflow.functions.ranking import By, global_rank
from skuflow.operators import features, inventory
from skuflow.params import InventoryParams

D1_SCHEMA = ("product_id long, category string, forecast_demand decimal(18,2), past_demand decimal(18,2), "
             "demand_sigma decimal(18,2), net_profit decimal(18,2), profit_margin_pct decimal(18,2), "
             "unit_cogs decimal(18,2), unit_price decimal(18,2), lead_time_months decimal(18,2), "
             "safety_stock decimal(18,2), reorder_point decimal(18,2), modeled_current_stock decimal(18,2), "
             "mape_pct decimal(18,2), mae decimal(18,2), confidence string, verdict string, "
             "excess_units decimal(18,2), at_risk_units decimal(18,2)")


def _d1(spark, rows):
    full = []
    for pid, f, past, stock, rop, verdict, conf in rows:
        full.append((pid, "c", D(f), D(past), D("0"), D("-5"), D("5"), D("2"), D("10"), D("2"), D("0"),
                     D(rop), D(stock), D("10"), D("1"), conf, verdict, max(D(stock) - D(rop), D(0)), D(f) * 2))
    return spark.createDataFrame(full, D1_SCHEMA)


def test_urgency_branches(spark):
    d1 = _d1(spark, [(1, "10", "2", "5", "20", "REORDER NOW", "high"),     # 0.5 months of cover -> critical
                     (2, "10", "3", "15", "20", "REORDER NOW", "low"),     # 1.5 < lead time 2 -> high
                     (3, "10", "6", "25", "30", "REORDER NOW", "low"),     # 2.5 -> elevated
                     (4, "0", "0", "0", "0", "REORDER NOW", "none")])      # no forecast -> elevated
    got = {r["product_id"]: (r["urgency"].split(" ")[0], r["months_of_cover"], r["risk_rank"])
           for r in inventory.stockout_register(d1).collect()}
    assert got[1][0] == "Critical" and got[2][0] == "High" and got[3][0] == "Elevated"
    assert got[4][0] == "Elevated" and got[4][1] is None
    assert sorted(v[2] for v in got.values()) == [1, 2, 3, 4]


def test_trend_new_sporadic_and_no_forecast(spark):
    d1 = _d1(spark, [(1, "1", "0", "0", "0", "REORDER NOW", "high"), (2, "1.16", "1", "4", "1", "HOLD", "low"),
                     (3, "1.15", "1", "4", "1", "HOLD", "low"), (4, "0.85", "1", "4", "1", "HOLD", "low"),
                     (5, "0.84", "1", "4", "1", "HOLD", "low")])
    got = {r["product_id"]: (r["trend_flag"], r["demand_change_pct"]) for r in inventory.demand_trend(d1).collect()}
    assert got[1] == ("New / sporadic", None)
    assert [got[i][0] for i in (2, 3, 4, 5)] == ["GROWING", "STABLE", "STABLE", "DECLINING"]
    prof = spark.createDataFrame([(1, "c", D("100"), D("10"), D("10.00"), D("4.5")),
                                  (9, "c", D("100"), D("-10"), None, D("3.5"))],
                                 "product_id long, category string, gross_revenue decimal(18,2), "
                                 "net_profit decimal(18,2), profit_margin_pct decimal(18,2), "
                                 "avg_review_score decimal(18,2)")
    q = {r["product_id"]: r for r in inventory.margin_review_quadrant(prof, d1).collect()}
    assert q[9]["demand_trend"] == "No forecast" and q[9]["demand_change_pct"] == "—"
    assert q[9]["forecast_confidence"] == "n/a" and q[9]["quadrant"].startswith("Review for exit")
    assert q[1]["quadrant"].startswith("Fix economics") and q[1]["demand_trend"] == "New / sporadic"


def test_scale_discontinue_needs_a_higher_margin_floor(spark):
    p = InventoryParams(margin_floor_pct=30.0)
    base = spark.createDataFrame([(D("0.5"), D("28"), D("1"), D("1"))],
                                 "forecast_demand decimal(18,2), profit_margin_pct decimal(18,2), "
                                 "modeled_current_stock decimal(18,2), reorder_point decimal(18,2)")
    assert base.select(inventory.verdict(p)).first()[0] == "DISCONTINUE"
    assert base.select(inventory.verdict(InventoryParams())).first()[0] == "REORDER NOW"
    cls = spark.createDataFrame([(1, "c", D("28"), D("4.5"))], "product_id long, category string, "
                                "profit_margin_pct decimal(18,2), avg_review_score decimal(18,2)") \
        .withColumn("decision", features.classify())
    d1 = _d1(spark, [(1, "0.5", "1", "1", "1", "DISCONTINUE", "low")])
    sig = inventory.strategy_vs_ops(cls, d1).first()
    assert sig["strategy_class"] == "SCALE" and sig["combined_signal"].startswith("Conflict: strategic winner")


def test_zero_revenue_and_null_status(spark):
    rev = spark.createDataFrame([(1, 2, D("0.00"), 1)], "product_id long, units_sold long, "
                                "gross_revenue decimal(18,2), order_count long")
    costs = spark.createDataFrame([(1, "c", D("0"), D("5"), D("1"), D("0"), D("0"))],
                                  "product_id long, category string, cogs_total decimal(18,2), "
                                  "storage_cost_total decimal(18,2), fulfillment_cost_total decimal(18,2), "
                                  "return_cost_total decimal(18,2), freight_cost_total decimal(18,2)")
    reviews = spark.createDataFrame([], "product_id long, avg_review_score decimal(18,2)")
    r = features.sku_profitability(rev, costs, reviews, ranked=False).first()
    assert r["profit_margin_pct"] is None and r["net_profit"] == D("-6.00")
    orders = spark.createDataFrame([(1, None), (2, "delivered"), (3, "canceled")], "order_id long, order_status string")
    from skuflow.functions.columns import valid_orders
    assert [x[0] for x in valid_orders(orders, ("canceled", "unavailable")).collect()] == [2]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=6), min_size=1, max_size=60))
def test_global_rank_property(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v long").repartition(3)
    order = [By("v", desc=True), By("id")]
    ours = sorted((r["id"], r["rk"]) for r in global_rank(df, order, "rk").collect())
    ref = sorted((r["id"], r["rk"]) for r in df.select("id", F.row_number().over(Window.orderBy(*[b.order() for b in order]))
                                                       .alias("rk")).collect())
    assert ours == ref
