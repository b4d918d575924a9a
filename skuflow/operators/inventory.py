"""Inventory decisions (D1-D14) and the inventory KPI scorecard (K2).

D1 is a handful of SKU-grain joins on product_id plus projections; every
report below reads D1 (persisted by the pipeline). Money at stake is exact
DECIMAL arithmetic on the 2-dp figures of D1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.functions.columns import (exact_avg, exact_div, as_double, money, opportunity, pct_text, round_dec, round_half_up,
                                       safe_pct)
from skuflow.functions.ranking import By, global_rank, medians, scorecard
from skuflow.operators.demand import pop_sigma
from skuflow.params import InventoryParams

# Fixed label texts.
VERDICTS = ("DISCONTINUE", "REDUCE STOCK", "REORDER NOW", "HOLD")
URGENCY = ("Critical — depletes within a month", "High — depletes before restock lands",
           "Elevated — below reorder point")
ACTIONS = {"DISCONTINUE": "Delist — stop carrying a dead, loss-making SKU",
           "REDUCE STOCK": "Run down / promote — free trapped capital",
           "REORDER NOW": "Replenish now — protect forecast sales from stockout"}
NO_ACTION = "No action"
QUADRANTS = ("Star — loved & profitable", "Fix economics — loved but thin/losing",
             "Fix experience — profitable but disliked", "Review for exit — weak on both")
SIGNALS = ("Conflict: strategic winner flagged dead — investigate",
           "Conflict: restocking a SKU marked for exit — confirm first",
           "Priority: grow & restock — protect a winner",
           "Consensus exit — strategy & ops agree, drop it",
           "Free capital — trim overstock", "Maintain")
IMPACT_LABELS = {"DISCONTINUE": (1, "DISCONTINUE — losses eliminated"),
                 "REDUCE STOCK": (2, "REDUCE STOCK — capital freed"),
                 "REORDER NOW": (3, "REORDER NOW — sales protected"),
                 "HOLD": (4, "HOLD — no action (capital correctly deployed)")}
TOTAL_LABEL = "TOTAL — opportunity (actionable only) | capital (all SKUs)"
TREND_NEW, TREND_NONE = "New / sporadic", "No forecast"


def _avg2(c: str) -> Column:
    return exact_avg(c, 2)


def forecast_summary(forecasts: DataFrame, grain: str, key: str) -> DataFrame:
    """Per key of one grain: mean forecast, MAPE, MAE (2 dp), max confidence."""
    return forecasts.where(F.col("grain") == grain).groupBy(key).agg(
        F.max("category").alias("f_category"), _avg2("predicted_units").alias("forecast_demand"),
        _avg2("mape_pct").alias("mape_pct"), _avg2("mae").alias("mae"), F.max("confidence").alias("confidence"))


def _stock_columns(p: InventoryParams) -> dict[str, Column]:
    sig = as_double("demand_sigma")
    safety = F.lit(p.z_service_level) * sig * F.sqrt(F.lit(p.lead_time_months))
    return {
        "safety_stock": round_half_up(safety, 2),
        "reorder_point": round_half_up(as_double("forecast_demand") * F.lit(p.lead_time_months) + safety, 2),
        "modeled_current_stock": round_half_up(F.lit(p.coverage_months) * as_double("past_demand"), 2),
    }


def verdict(p: InventoryParams) -> Column:
    f, m = F.col("forecast_demand"), F.col("profit_margin_pct")
    stock, rop = F.col("modeled_current_stock"), F.col("reorder_point")
    return (F.when((f < p.dead_demand_threshold) & (m < p.margin_floor_pct), "DISCONTINUE")
            .when(stock <= rop, "REORDER NOW")
            .when(stock > F.lit(p.overstock_multiple) * rop, "REDUCE STOCK")
            .otherwise("HOLD"))


D1_COLUMNS = ["product_id", "category", "forecast_demand", "past_demand", "demand_sigma", "net_profit",
              "profit_margin_pct", "unit_cogs", "unit_price", "lead_time_months", "safety_stock",
              "reorder_point", "modeled_current_stock", "mape_pct", "mae", "confidence", "verdict",
              "excess_units", "at_risk_units"]


def sku_decisions(forecasts: DataFrame, features: DataFrame, profitability: DataFrame,
                  p: InventoryParams = InventoryParams()) -> DataFrame:
    """SKUs having a forecast, demand features and profitability.
    ``profitability`` carries units_sold and cogs_total (F5, F6) so the join
    is three-way instead of five-way, all on the typed product id (the forecast
    table keeps ids as text, so they are read back as what they were)."""
    f = forecast_summary(forecasts, "sku", "grain_key").select(
        F.col("grain_key").try_cast(features.schema["product_id"].dataType).alias("product_id"), F.col("*")).drop("grain_key")
    b = f.join(features.select("product_id", "past_demand", "demand_sigma"), "product_id").join(
        profitability.select("product_id", "net_profit", "profit_margin_pct", "units_sold", "cogs_total",
                             "gross_revenue"), "product_id")
    b = b.withColumns({
        "category": F.col("f_category"),
        "unit_cogs": exact_div("cogs_total", "units_sold"),
        "unit_price": exact_div("gross_revenue", "units_sold"),
        "lead_time_months": F.lit(p.lead_time_months).cast("decimal(18,2)"),
    }).withColumns(_stock_columns(p))
    b = b.withColumns({
        "verdict": verdict(p),
        "excess_units": F.greatest(F.col("modeled_current_stock") - F.col("reorder_point"),
                                   F.lit(0).cast("decimal(18,2)")).cast("decimal(18,2)"),
        "at_risk_units": round_dec(F.col("forecast_demand") * F.lit(p.lead_time_months).cast("decimal(18,2)")),
    })
    return b.select(*D1_COLUMNS)


def category_decisions(forecasts: DataFrame, monthly: DataFrame, profitability: DataFrame,
                       p: InventoryParams = InventoryParams()) -> DataFrame:
    """The same engine on categories (monthly category sums; weighted margin)."""
    f = forecast_summary(forecasts, "category", "category")
    cm = monthly.groupBy("category", "order_month").agg(F.sum("units_sold").alias("u"))
    dmd = cm.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("u").alias("s"),
                                     F.sum(F.col("u") * F.col("u")).alias("ss"))
    dmd = dmd.select("category", round_half_up(as_double("s") / as_double("n"), 2).alias("past_demand"),
                     round_half_up(pop_sigma(F.col("n"), F.col("s"), F.col("ss")), 2).alias("demand_sigma"))
    econ = profitability.groupBy("category").agg(F.sum("net_profit").alias("net_profit"),
                                                 F.sum("gross_revenue").alias("rev"))
    econ = econ.select("category", F.col("net_profit").cast("decimal(38,2)"),
                       safe_pct("net_profit", "rev", 2).alias("profit_margin_pct"))
    b = f.join(dmd, "category").join(econ, "category").withColumns(_stock_columns(p))
    return b.withColumn("verdict", verdict(p)).select(
        "category", "forecast_demand", "past_demand", "demand_sigma", "net_profit", "profit_margin_pct",
        "safety_stock", "reorder_point", "modeled_current_stock", "mape_pct", "mae", "confidence", "verdict")


def _units(c: str) -> Column:
    return F.round(F.col(c), 0).cast("int")


def _change_pct() -> Column:
    f, pdm = as_double("forecast_demand"), as_double("past_demand")
    return (f - pdm) * 100.0 / F.nullif(pdm, F.lit(0.0))


def _trend() -> Column:
    f, pdm = F.col("forecast_demand"), F.col("past_demand")
    return (F.when(pdm == 0, TREND_NEW)
            .when((f - pdm) * 100 > pdm * 15, "GROWING")
            .when((f - pdm) * 100 < pdm * -15, "DECLINING")
            .otherwise("STABLE"))


def demand_trend(decisions: DataFrame) -> DataFrame:
    """D3: forecast vs past demand."""
    return decisions.select(
        "product_id", "category", _units("past_demand").alias("past_demand_units"),
        _units("forecast_demand").alias("forecast_demand_units"),
        round_half_up(_change_pct(), 1).alias("demand_change_pct"), "verdict", _trend().alias("trend_flag"))


def _cover() -> Column:
    return round_half_up(as_double("modeled_current_stock") / F.nullif(as_double("forecast_demand"), F.lit(0.0)), 1)


def stockout_register(decisions: DataFrame, p: InventoryParams = InventoryParams()) -> DataFrame:
    """REORDER NOW SKUs ranked by sales at risk (distributed rank)."""
    f, stock = F.col("forecast_demand"), F.col("modeled_current_stock")
    urgency = (F.when((f > 0) & (stock < f), URGENCY[0])
               .when((f > 0) & (stock < f * F.lit(p.lead_time_months).cast("decimal(18,2)")), URGENCY[1])
               .otherwise(URGENCY[2]))
    r = decisions.where(F.col("verdict") == "REORDER NOW").withColumn(
        "_risk", F.col("at_risk_units") * F.col("unit_price"))
    r = global_rank(r, [By("_risk", desc=True, nulls_first=True), By("product_id")], "risk_rank")
    return r.select(
        "product_id", "category", _units("forecast_demand").alias("forecast_demand_units"),
        _units("modeled_current_stock").alias("modeled_stock_units"),
        _units("reorder_point").alias("reorder_point_units"), _cover().alias("months_of_cover"),
        round_dec("_risk").alias("sales_at_risk_brl"), "confidence", urgency.alias("urgency"), "risk_rank")


def _action() -> Column:
    v = F.col("verdict")
    expr = None
    for k, text in ACTIONS.items():
        expr = F.when(v == k, text) if expr is None else expr.when(v == k, text)
    return expr.otherwise(NO_ACTION)


def action_list(decisions: DataFrame) -> DataFrame:
    """Non-HOLD SKUs with money at stake, action text and priority rank."""
    r = decisions.where(F.col("verdict") != "HOLD").withColumn("_opp", opportunity())
    r = global_rank(r, [By("_opp", desc=True, nulls_first=True), By("product_id")], "priority_rank")
    return r.select(
        "product_id", "category", "verdict", "profit_margin_pct",
        _units("forecast_demand").alias("forecast_demand_units"),
        _units("modeled_current_stock").alias("modeled_stock_units"),
        _units("reorder_point").alias("reorder_point_units"),
        round_dec("_opp").alias("opportunity_value_brl"), _action().alias("recommended_action"), "priority_rank")


def margin_review_quadrant(profitability: DataFrame, decisions: DataFrame, currency: str = "$") -> DataFrame:
    """Reviewed SKUs by review x margin quadrant, with demand trend."""
    e = decisions.select("product_id", "forecast_demand", "past_demand", "confidence")
    df = profitability.where(F.col("avg_review_score").isNotNull()).join(e, "product_id", "left")
    r, m = F.col("avg_review_score"), F.col("profit_margin_pct")
    quadrant = (F.when((r >= 4.0) & (m >= 20), QUADRANTS[0]).when((r >= 4.0) & (m < 20), QUADRANTS[1])
                .when((r < 4.0) & (m >= 20), QUADRANTS[2]).otherwise(QUADRANTS[3]))
    trend = F.when(F.col("forecast_demand").isNull(), TREND_NONE).otherwise(_trend())
    return df.select(
        "product_id", "category", "avg_review_score", pct_text(round_dec(m, 1)).alias("profit_margin_pct"),
        money("net_profit", currency).alias("net_profit"), quadrant.alias("quadrant"),
        _units("forecast_demand").alias("forecast_demand_units"), trend.alias("demand_trend"),
        F.coalesce(pct_text(round_half_up(_change_pct(), 1)), F.lit("—")).alias("demand_change_pct"),
        F.coalesce(F.col("confidence"), F.lit("n/a")).alias("forecast_confidence"))


def strategy_vs_ops(classified: DataFrame, decisions: DataFrame) -> DataFrame:
    """Strategic class x inventory verdict -> combined signal (first match wins)."""
    df = classified.select("product_id", "category", F.col("decision").alias("strategy_class"),
                           "profit_margin_pct", "avg_review_score") \
        .join(decisions.select("product_id", F.col("verdict").alias("inventory_verdict"), "forecast_demand"),
              "product_id")
    c, v = F.col("strategy_class"), F.col("inventory_verdict")
    signal = (F.when((c == "SCALE") & (v == "DISCONTINUE"), SIGNALS[0])
              .when((c == "EXIT") & (v == "REORDER NOW"), SIGNALS[1])
              .when((c == "SCALE") & (v == "REORDER NOW"), SIGNALS[2])
              .when((c == "EXIT") & (v == "DISCONTINUE"), SIGNALS[3])
              .when(v == "REDUCE STOCK", SIGNALS[4]).otherwise(SIGNALS[5]))
    return df.select("product_id", "category", "strategy_class", "inventory_verdict", "profit_margin_pct",
                     "avg_review_score", _units("forecast_demand").alias("forecast_demand_units"),
                     signal.alias("combined_signal"))


def strategy_matrix(classified: DataFrame, decisions: DataFrame) -> DataFrame:
    """Class rows x verdict counts (conditional counts, one aggregation)."""
    df = classified.select("product_id", "decision").join(decisions.select("product_id", "verdict"), "product_id")
    v = F.col("verdict")
    return df.groupBy(F.col("decision").alias("strategy_class")).agg(
        F.count_if(v == "REORDER NOW").alias("reorder_now"), F.count_if(v == "HOLD").alias("hold"),
        F.count_if(v == "REDUCE STOCK").alias("reduce_stock"), F.count_if(v == "DISCONTINUE").alias("discontinue"),
        F.count(F.lit(1)).alias("total_skus"))


def _sheet_base(decisions: DataFrame, classified: DataFrame, revenue: DataFrame) -> DataFrame:
    c = classified.select("product_id", F.col("gross_revenue").alias("c_gross_revenue"),
                          F.col("net_profit").alias("c_net_profit"), F.col("profit_margin_pct").alias("c_margin"),
                          "avg_review_score", "sku_rank", F.col("decision").alias("strategy_class"))
    r = revenue.select("product_id", "units_sold", F.col("gross_revenue").alias("r_gross_revenue"))
    return decisions.join(c, "product_id").join(r, "product_id").withColumn("_opp", opportunity())


def action_sheet(decisions: DataFrame, classified: DataFrame, revenue: DataFrame) -> DataFrame:
    """One row per SKU: ops + strategy + money at stake + deployed capital."""
    b = _sheet_base(decisions, classified, revenue)
    return b.select(
        "product_id", "category", "units_sold", F.col("c_gross_revenue").alias("gross_revenue"),
        F.col("c_net_profit").alias("net_profit"), F.col("c_margin").alias("profit_margin_pct"),
        "avg_review_score", "sku_rank", "strategy_class", F.col("verdict").alias("inventory_verdict"),
        _units("forecast_demand").alias("forecast_demand_units"),
        _units("modeled_current_stock").alias("modeled_stock_units"),
        _units("reorder_point").alias("reorder_point_units"), _cover().alias("months_of_cover"),
        round_dec("_opp").alias("opportunity_value_brl"),
        round_dec(F.col("modeled_current_stock") * F.col("unit_cogs")).alias("deployed_capital_brl"),
        "mape_pct", "confidence")


def sku_snapshot(decisions: DataFrame, classified: DataFrame, revenue: DataFrame) -> DataFrame:
    """The richer per-SKU record."""
    b = _sheet_base(decisions, classified, revenue)
    return b.select(
        "product_id", "category", "sku_rank", "strategy_class", F.col("verdict").alias("inventory_verdict"),
        F.col("units_sold").alias("total_units_sold"), F.col("r_gross_revenue").alias("total_revenue"),
        F.col("c_net_profit").alias("total_net_profit"),
        round_dec(F.col("units_sold").cast("decimal(20,0)") * F.col("unit_cogs")).alias("total_cogs_brl"),
        F.col("c_margin").alias("profit_margin_pct"), "avg_review_score", "unit_cogs", "unit_price",
        _units("forecast_demand").alias("forecast_demand_units"),
        _units("modeled_current_stock").alias("modeled_stock_units"),
        _units("reorder_point").alias("reorder_point_units"), _cover().alias("months_of_cover"),
        round_dec("_opp").alias("opportunity_value_brl"),
        round_dec(F.col("modeled_current_stock") * F.col("unit_cogs")).alias("deployed_capital_brl"),
        "mape_pct", "mae", "confidence")


def monthly_economics(monthly: DataFrame, decisions: DataFrame) -> DataFrame:
    """Monthly SKU performance with unit economics (COGS, gross profit)."""
    df = monthly.join(decisions.select("product_id", "unit_cogs"), "product_id")
    cogs = F.col("units_sold").cast("decimal(20,0)") * F.col("unit_cogs")
    return df.select("product_id", "category", "order_month", "units_sold",
                     F.col("revenue").alias("monthly_revenue"), round_dec(cogs).alias("monthly_cogs_brl"),
                     round_dec(F.col("revenue") - cogs).alias("monthly_gross_profit_brl"),
                     F.col("avg_review_score").alias("monthly_avg_review_score"))


def verdict_impact(decisions: DataFrame, currency: str = "$") -> DataFrame:
    """Per verdict count / money at stake / deployed capital, plus a TOTAL
    row (actionable money, all capital). The per-verdict frame has at most
    four rows, so the total is computed from it."""
    per = decisions.groupBy("verdict").agg(
        F.count(F.lit(1)).alias("n"), round_dec(F.sum(opportunity()), 2, 38).alias("opp"),
        round_dec(F.sum(F.col("modeled_current_stock") * F.col("unit_cogs")), 2, 38).alias("cap"))
    sort = None
    label = None
    for k, (i, text) in IMPACT_LABELS.items():
        sort = F.when(F.col("verdict") == k, i) if sort is None else sort.when(F.col("verdict") == k, i)
        label = F.when(F.col("verdict") == k, text) if label is None else label.when(F.col("verdict") == k, text)
    per = per.select(sort.alias("sort_order"), label.alias("opportunity"), "n", "opp", "cap")
    actionable = F.col("sort_order") <= 3
    total = per.agg(
        F.lit(5).alias("sort_order"), F.lit(TOTAL_LABEL).alias("opportunity"),
        F.concat(F.coalesce(F.sum(F.when(actionable, F.col("n")).otherwise(0)), F.lit(0)).cast("string"),
                 F.lit(" | "), F.coalesce(F.sum("n"), F.lit(0)).cast("string")).alias("sku_count"),
        F.sum(F.when(actionable, F.col("opp")).otherwise(F.lit(0))).alias("opp"), F.sum("cap").alias("cap"))
    rows = per.select("sort_order", "opportunity", F.col("n").cast("string").alias("sku_count"), "opp", "cap") \
        .unionByName(total)
    return rows.select("opportunity", "sku_count", money("opp", currency).alias("opportunity_brl"),
                       money("cap", currency).alias("deployed_capital_brl"))


def category_impact(decisions: DataFrame) -> DataFrame:
    """Per category verdict counts and money at stake."""
    v = F.col("verdict")
    loss = F.when(v == "DISCONTINUE", F.greatest(-F.col("net_profit"), F.lit(0).cast("decimal(18,2)")))
    freed = F.when(v == "REDUCE STOCK", F.col("excess_units") * F.col("unit_cogs"))
    prot = F.when(v == "REORDER NOW", F.col("at_risk_units") * F.col("unit_price"))
    zero = F.lit(0).cast("decimal(18,2)")
    a = decisions.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_skus"), F.count_if(v == "REORDER NOW").alias("reorder_skus"),
        F.count_if(v == "HOLD").alias("hold_skus"), F.count_if(v == "REDUCE STOCK").alias("reduce_skus"),
        F.count_if(v == "DISCONTINUE").alias("discontinue_skus"),
        F.sum(F.coalesce(loss, zero)).alias("l"), F.sum(F.coalesce(freed, zero)).alias("f"),
        F.sum(F.coalesce(prot, zero)).alias("p"))
    return a.select("category", "total_skus", "reorder_skus", "hold_skus", "reduce_skus", "discontinue_skus",
                    round_dec("l", 2, 38).alias("losses_eliminated_brl"),
                    round_dec("f", 2, 38).alias("capital_freed_brl"),
                    round_dec("p", 2, 38).alias("sales_protected_brl"),
                    round_dec(F.col("l") + F.col("f") + F.col("p"), 2, 38).alias("total_opportunity_brl"))


def inventory_scorecard(decisions: DataFrame, forecasts: DataFrame, currency: str = "$") -> DataFrame:
    """K2: 13 long-form metrics (metric, value, value_display)."""
    v = F.col("verdict")
    zero = F.lit(0).cast("decimal(18,2)")
    k = decisions.agg(
        F.count(F.lit(1)).alias("skus"), F.count_if(v != "HOLD").alias("actionable"),
        F.count_if(v == "REORDER NOW").alias("reorder_now"), F.count_if(v == "HOLD").alias("hold"),
        F.count_if(v == "REDUCE STOCK").alias("reduce_stock"), F.count_if(v == "DISCONTINUE").alias("discontinue"),
        F.coalesce(F.sum(F.when(v == "DISCONTINUE", F.greatest(-F.col("net_profit"), zero))), zero).alias("losses"),
        F.coalesce(F.sum(F.when(v == "REDUCE STOCK", F.col("excess_units") * F.col("unit_cogs"))), zero)
        .alias("freed"),
        F.coalesce(F.sum(F.when(v == "REORDER NOW", F.col("at_risk_units") * F.col("unit_price"))), zero)
        .alias("protected_"))
    cat = forecasts.where(F.col("grain") == "category").groupBy("category").agg(
        exact_avg("mape_pct", 6)
        .alias("m"))
    row = k.withColumns({"mape_sku": F.round(medians(decisions, [], {"x": (F.col("mape_pct"), 2)}).scalar(), 1),
                         "mape_cat": F.round(medians(cat, [], {"x": (F.col("m"), 6)}).scalar(), 1)})
    share = round_half_up(as_double("actionable") * 100.0 / F.nullif(as_double("skus"), F.lit(0.0)), 1)
    total = F.col("losses") + F.col("freed") + F.col("protected_")

    def cnt(c):
        return F.col(c), F.col(c).cast("string")

    def cash(x):
        return round_dec(x, 2, 38), money(round_dec(x, 2, 38), currency)

    def pc(x):
        return x, F.concat(x.cast("decimal(18,1)").cast("string"), F.lit("%"))

    metrics = [
        (1, "SKUs in decision engine", *cnt("skus")), (2, "Actionable SKUs", *cnt("actionable")),
        (3, "Actionable share", *pc(share)), (4, "REORDER NOW (SKUs)", *cnt("reorder_now")),
        (5, "HOLD (SKUs)", *cnt("hold")), (6, "REDUCE STOCK (SKUs)", *cnt("reduce_stock")),
        (7, "DISCONTINUE (SKUs)", *cnt("discontinue")), (8, "Losses eliminated", *cash(F.col("losses"))),
        (9, "Capital freed", *cash(F.col("freed"))), (10, "Sales protected", *cash(F.col("protected_"))),
        (11, "Total opportunity", *cash(total)),
        (12, "Median forecast MAPE — category", *pc(F.col("mape_cat"))),
        (13, "Median forecast MAPE — SKU", *pc(F.col("mape_sku"))),
    ]
    return scorecard(row, metrics, "decimal(38,2)").select("metric", "value", "value_display")


__all__ = ["sku_decisions", "category_decisions", "demand_trend", "stockout_register", "action_list",
           "margin_review_quadrant", "strategy_vs_ops", "strategy_matrix", "action_sheet", "sku_snapshot",
           "monthly_economics", "verdict_impact", "category_impact", "inventory_scorecard"]
