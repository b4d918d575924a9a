"""Profitability analyses (P1-P8): where the money is made and lost."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.functions.columns import (as_double, dominant, money, pct_text, round_dec, round_half_up,
                                       safe_pct)
from skuflow.functions.ranking import By, bounded_broadcast, global_running
from skuflow.operators.features import COST_COLUMNS

# Fixed labels of the class-impact rows.
EXIT_LABEL = "EXIT SKUs — eliminating losses"
SCALE_LABEL = "SCALE SKUs — 20% revenue uplift opportunity"
OPTIMIZE_LABEL = "OPTIMIZE SKUs — 5pp margin improvement opportunity"
SCALE_UPLIFT = Decimal("0.20")
OPTIMIZE_UPLIFT = Decimal("0.05")

# Stress scenarios: name -> cost component factors.
SCENARIOS: list[tuple[str, dict[str, Decimal]]] = [
    ("Baseline", {}),
    ("Freight +20%", {"freight_cost_total": Decimal("1.20")}),
    ("Returns +50%", {"return_cost_total": Decimal("1.50")}),
    ("Storage +30%", {"storage_cost_total": Decimal("1.30")}),
]


def class_impact(classified: DataFrame) -> DataFrame:
    """One conditional-aggregation pass, then three fixed rows. A class
    with no SKU still has its row (count 0, NULL sums)."""
    d, net, rev = F.col("decision"), F.col("net_profit"), F.col("gross_revenue")
    m = F.col("profit_margin_pct")
    a = classified.agg(
        F.count_if(d == "EXIT").alias("exit_n"),
        F.sum(F.when(d == "EXIT", F.when(net < 0, F.abs(net)).otherwise(F.lit(0)))).alias("exit_loss"),
        F.sum(F.when(d == "EXIT", rev)).alias("exit_rev"),
        F.count_if(d == "SCALE").alias("scale_n"),
        F.sum(F.when(d == "SCALE", rev)).alias("scale_rev"),
        F.sum(F.when(d == "SCALE", m)).alias("scale_m_sum"),
        F.count(F.when(d == "SCALE", m)).alias("scale_m_n"),
        F.count_if(d == "OPTIMIZE").alias("opt_n"),
        F.sum(F.when(d == "OPTIMIZE", rev)).alias("opt_rev"))
    # sum(rev) * 0.20 * avg(margin) / 100 == sum(rev) * sum(m) / (500 * n)
    scale_value = round_half_up(as_double("scale_rev") * as_double("scale_m_sum")
                                / (F.lit(100.0 / float(SCALE_UPLIFT)) * F.nullif(F.col("scale_m_n"), F.lit(0))), 2)
    rows = [
        (EXIT_LABEL, F.col("exit_n"), round_dec("exit_loss", 2, 38), round_dec("exit_rev", 2, 38)),
        (SCALE_LABEL, F.col("scale_n"), scale_value.cast("decimal(38,2)"), round_dec("scale_rev", 2, 38)),
        (OPTIMIZE_LABEL, F.col("opt_n"), round_dec(F.col("opt_rev") * F.lit(OPTIMIZE_UPLIFT), 2, 38),
         round_dec("opt_rev", 2, 38)),
    ]
    structs = [F.struct(F.lit(label).alias("opportunity"), n.cast("long").alias("sku_count"),
                        v.alias("potential_value_brl"), r.alias("revenue_in_scope")) for label, n, v, r in rows]
    return a.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def profit_pareto(profitability: DataFrame, currency: str = "$") -> DataFrame:
    """Profitable SKUs by net profit: rank, cumulative profit share (equal
    profits share one running total, as SQL's RANGE frame) and SKU share."""
    pos = profitability.where(F.col("net_profit") > 0).select("product_id", "category", "net_profit")
    order = [By("net_profit", desc=True), By("product_id")]
    ranked = global_running(pos, "net_profit", order, rank_name="profit_rank", peers_name="running_profit")
    # Totals are a scalar subquery: computed once, no join.
    totals = pos.agg(F.struct(F.sum("net_profit").alias("profit"), F.count(F.lit(1)).alias("skus"))).scalar()
    df = ranked.withColumns({"total_profit": totals.getField("profit"), "total_skus": totals.getField("skus")})
    return df.select(
        "profit_rank", "product_id", "category",
        money("net_profit", currency).alias("net_profit"),
        pct_text(round_half_up(F.lit(100.0) * as_double("running_profit")
                               / F.nullif(as_double("total_profit"), F.lit(0.0)), 1)).alias("cumulative_profit_pct"),
        pct_text(round_half_up(F.lit(100.0) * as_double("profit_rank")
                               / F.nullif(as_double("total_skus"), F.lit(0.0)), 1)).alias("cumulative_sku_pct"))


def loss_leaders(profitability: DataFrame, costs: DataFrame, n: int = 50, currency: str = "$") -> DataFrame:
    """The ``n`` largest losses with their dominant cost driver (top-k:
    Spark plans TakeOrderedAndProject, no global sort)."""
    c = costs.drop("category")
    df = profitability.select("product_id", "category", "gross_revenue", "net_profit") \
        .where(F.col("net_profit") < 0).join(c, "product_id") \
        .orderBy(F.col("net_profit").asc(), F.col("product_id").asc_nulls_last()).limit(n)
    driver = dominant([("cogs_total", "COGS"), ("freight_cost_total", "Freight"), ("return_cost_total", "Returns"),
                       ("storage_cost_total", "Storage"), ("fulfillment_cost_total", "Fulfillment")])
    return df.select(
        "product_id", "category",
        money("gross_revenue", currency).alias("gross_revenue"), money("net_profit", currency).alias("net_loss"),
        *[money(x, currency).alias(x) for x in ["cogs_total", "freight_cost_total", "return_cost_total",
                                                 "storage_cost_total", "fulfillment_cost_total"]],
        driver.alias("dominant_cost_driver"))


def middle_month(month_col: str = "order_month") -> tuple[Column, Column]:
    """(min, max) aggregate expressions; see ``split_month_of``."""
    return F.min(month_col).alias("_min_m"), F.max(month_col).alias("_max_m")


def split_month_of(df: DataFrame) -> Column:
    """Scalar subquery: the month halfway between the first and last month of ``df``."""
    first = F.to_date(F.concat(F.col("_min_m"), F.lit("-01")))
    last = F.to_date(F.concat(F.col("_max_m"), F.lit("-01")))
    span = F.months_between(last, first).cast("int")
    return df.agg(*middle_month()).select(
        F.date_format(F.add_months(first, F.floor(span / 2).cast("int")), "yyyy-MM").alias("_split")).scalar()


def category_margin_drift(base: DataFrame, product_cat: DataFrame, supplier_costs: DataFrame,
                          split_month: str | None = None, max_rows: int = 200_000,
                          small: bool | None = None) -> DataFrame:
    """margin = revenue x (1 - cogs rate) - freight per category, first vs
    second half (month <= split). Only the supplier cost rate is needed, so a
    category without its other cost rows still counts. Sums are linear, so the
    two halves are two conditional sums of one groupBy instead of a self-join."""
    rows = base.where(F.col("order_month").isNotNull()).select("product_id", "order_month", "revenue", "freight") \
        .join(product_cat, "product_id").join(bounded_broadcast(supplier_costs.select("category", "cogs_rate"), max_rows, small), "category")
    if split_month is None:
        split = split_month_of(base.where(F.col("order_month").isNotNull()))
    else:
        split = F.lit(split_month)
    first = F.col("order_month") <= split
    # a product's month without any price still has its freight
    zero = F.lit(0).cast("decimal(18,2)")
    margin = F.coalesce("revenue", zero) * (F.lit(1) - F.col("cogs_rate")) - F.coalesce("freight", zero)
    agg = rows.groupBy("category").agg(
        F.count_if(first).alias("n1"), F.count_if(~first).alias("n2"),
        F.sum(F.when(first, F.col("revenue"))).alias("rev1"), F.sum(F.when(~first, F.col("revenue"))).alias("rev2"),
        F.sum(F.when(first, margin)).alias("mar1"), F.sum(F.when(~first, margin)).alias("mar2"))
    agg = agg.where((F.col("n1") > 0) & (F.col("n2") > 0))
    p1 = as_double("mar1") * 100.0 / F.nullif(as_double("rev1"), F.lit(0.0))
    p2 = as_double("mar2") * 100.0 / F.nullif(as_double("rev2"), F.lit(0.0))
    change = p2 - p1
    return agg.select(
        "category", round_half_up(p1, 2).alias("margin_pct_first_half"),
        round_half_up(p2, 2).alias("margin_pct_second_half"), round_half_up(change, 2).alias("margin_change_pp"),
        F.when(change > 2, "IMPROVING").when(change < -2, "DETERIORATING").otherwise("STABLE").alias("trend_flag"),
        round_dec(F.col("rev1") + F.col("rev2"), 2, 38).alias("total_revenue"))


def _stressed_total(factors: Mapping[str, Decimal]) -> Column:
    terms = [F.col(c) * F.lit(factors[c]) if c in factors else F.col(c) for c in COST_COLUMNS]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def stress(revenue: DataFrame, costs: DataFrame, factors: Mapping[str, Decimal],
           with_total_cost: bool = False) -> DataFrame:
    """Cost components scaled by ``factors``; net and margin per SKU."""
    df = revenue.select("product_id", "gross_revenue").join(costs, "product_id")
    total = _stressed_total(factors)
    cols = ["product_id", "category", round_dec("gross_revenue").alias("gross_revenue")]
    if with_total_cost:
        cols.append(round_dec(total).alias("stressed_total_cost"))
    net = F.col("gross_revenue") - total
    cols += [round_dec(net).alias("stressed_net_profit"),
             safe_pct(net, "gross_revenue", 2).alias("stressed_margin_pct")]
    return df.select(*cols)


def stress_summary(revenue: DataFrame, costs: DataFrame,
                   scenarios: Sequence[tuple[str, Mapping[str, Decimal]]] = SCENARIOS) -> DataFrame:
    """Per scenario the unweighted average margin and total net profit.
    One pass over the SKUs computes every scenario as columns; no cross join."""
    df = revenue.select("product_id", "gross_revenue").join(costs, "product_id")
    aggs = []
    for i, (_, factors) in enumerate(scenarios):
        net = F.col("gross_revenue") - _stressed_total(factors)
        m = safe_pct(net, "gross_revenue", 2)
        aggs += [F.sum(m).alias(f"m{i}"), F.count(m).alias(f"c{i}"), F.sum(round_dec(net)).alias(f"n{i}")]
    a = df.agg(*aggs)
    structs = [F.struct(F.lit(name).alias("scenario"),
                        round_half_up(as_double(f"m{i}") / F.nullif(as_double(f"c{i}"), F.lit(0.0)), 2)
                        .alias("avg_margin_pct"),
                        round_dec(f"n{i}", 2, 38).alias("total_net_profit"))
               for i, (name, _) in enumerate(scenarios)]
    return a.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
