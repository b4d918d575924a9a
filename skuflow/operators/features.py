"""Dimensions, fact and SKU features (F1-F8).

The item table is the large one. It is joined to orders once, with the
reviews pre-aggregated per order (so the item x review fan-out is a weight,
not extra rows), and rolled up to (SKU, month) in one aggregation:
``sku_month_base``. F5, F6, F7a and F8 are all small aggregations of that base.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.functions.columns import round_dec, round_half_up, safe_pct, valid_orders
from skuflow.functions.ranking import By, bounded_broadcast, global_rank
from skuflow.sources.schemas import MONEY

COST_COLUMNS = ["cogs_total", "storage_cost_total", "fulfillment_cost_total",
                "return_cost_total", "freight_cost_total"]


def month_of(ts: str = "order_purchase_timestamp"):
    return F.date_format(F.col(ts), "yyyy-MM")


def dim_category(t: dict[str, DataFrame], max_rows: int = 200_000, small: bool | None = None) -> DataFrame:
    """translation joined to the four cost tables on the English name
    (categories lacking a cost row drop out). Small dimension: each join side
    is broadcast only after a row-count check."""
    ct = t["category_translation"].select(F.col("product_category_name_english").alias("category"))
    out = ct
    for name, cols in (("supplier_costs", ["cogs_rate"]), ("storage_costs", ["storage_cost_per_unit"]),
                       ("fulfillment_costs", ["fulfillment_cost_per_order"]),
                       ("return_costs", ["return_rate", "return_cost_per_unit"])):
        out = out.join(bounded_broadcast(t[name].select("category", *cols), max_rows, small), "category")
    return out.select("category", "cogs_rate", "storage_cost_per_unit", "fulfillment_cost_per_order",
                      "return_rate", "return_cost_per_unit")


def dim_date(orders: DataFrame) -> DataFrame:
    """distinct order dates; day_of_week with Sunday = 0."""
    ts = F.col("order_purchase_timestamp")
    return orders.where(ts.isNotNull()).select(
        F.to_date(ts).alias("order_date"), F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "yyyy-MM").alias("year_month"), F.date_format(ts, "MM").alias("month"),
        (F.dayofweek(ts) - 1).alias("day_of_week")).distinct()


def dim_product(products: DataFrame, translation: DataFrame, max_rows: int = 200_000,
                small: bool | None = None) -> DataFrame:
    """products with PT and EN category names (left join)."""
    tr = bounded_broadcast(translation.select(
        "product_category_name", F.col("product_category_name_english").alias("category_en")), max_rows, small)
    return products.join(tr, "product_category_name", "left").select(
        "product_id", F.col("product_category_name").alias("category_pt"), "category_en",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")


def product_category(products: DataFrame, translation: DataFrame, max_rows: int = 200_000,
                     small: bool | None = None) -> DataFrame:
    """(product_id, category): products whose PT name translates (inner join)."""
    tr = bounded_broadcast(translation.select(
        "product_category_name", F.col("product_category_name_english").alias("category")), max_rows, small)
    return products.select("product_id", "product_category_name") \
        .join(tr, "product_category_name").select("product_id", "category")


def fact_order_items(items: DataFrame, orders: DataFrame, reviews: DataFrame,
                     excluded: Iterable[str]) -> DataFrame:
    """item grain x reviews (an order with two reviews lists its items twice)."""
    vo = valid_orders(orders, excluded).select(
        "order_id", F.to_date("order_purchase_timestamp").alias("order_date"), "order_status")
    rv = reviews.select("order_id", "review_score")
    return items.join(vo.hint("merge"), "order_id").join(rv.hint("merge"), "order_id", "left").select(
        "order_id", "order_item_id", "product_id", "order_date", "order_status",
        "price", "freight_value", "review_score")


def review_stats_by_order(reviews: DataFrame) -> DataFrame:
    """Per order: number of review rows, score sum/count, scores <= 2."""
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.count("review_id").alias("n_review_ids"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_n"),
        F.sum(F.when(F.col("review_score") <= 2, 1).otherwise(0)).alias("neg_n"))


def sku_month_base(items: DataFrame, orders: DataFrame, reviews: DataFrame,
                   excluded: Iterable[str]) -> DataFrame:
    """Valid items rolled up to (product_id, order_month).

    ``units``/``revenue``/``freight``/``orders`` ignore reviews (F5, F6);
    ``units_w``/``revenue_w`` weight each item by its order's review count
    (at least 1), which equals counting the rows of the item x review join
    (F8); score sums feed the review averages (F7a, F8). order_month is NULL
    for orders without a purchase timestamp.
    """
    vo = valid_orders(orders, excluded).select("order_id", month_of().alias("order_month"))
    per_order = vo.join(review_stats_by_order(reviews).hint("merge"), "order_id", "left")
    # Fact-to-fact join: ask for a sort-merge join so a size estimate never
    # broadcasts either fact table through the driver (AQE may still switch to
    # a broadcast when the measured shuffle output is small).
    lines = items.select("order_id", "product_id", "price", "freight_value").join(
        per_order.hint("merge"), "order_id")
    n_rev = F.coalesce(F.col("n_reviews"), F.lit(0))
    weight = F.greatest(n_rev, F.lit(1))
    return lines.groupBy("product_id", "order_month").agg(
        F.count(F.lit(1)).alias("units"),
        F.sum("price").alias("revenue"),
        F.sum("freight_value").alias("freight"),
        F.count_distinct("order_id").alias("orders"),
        F.sum(weight).alias("units_w"),
        F.sum(F.col("price") * weight).alias("revenue_w"),
        F.sum("score_sum").alias("score_sum"),
        F.sum("score_n").alias("score_n"),
        F.sum(F.col("neg_n")).alias("neg_n"),
        F.sum(F.when(n_rev > 0, 1).otherwise(0)).alias("reviewed_items"))


def sku_revenue(base: DataFrame) -> DataFrame:
    """per SKU units, revenue, freight and distinct orders (no review join).
    An order has one month, so per-month distinct counts add up exactly."""
    return base.groupBy("product_id").agg(
        F.sum("units").alias("units_sold"),
        F.sum("revenue").cast(MONEY).alias("gross_revenue"),
        F.sum("freight").cast("decimal(38,4)").alias("freight_collected"),
        F.sum("orders").alias("order_count"))


def sku_costs(revenue: DataFrame, product_cat: DataFrame, categories: DataFrame,
              max_rows: int = 200_000, small: bool | None = None) -> DataFrame:
    """the category cost model applied to each SKU, each cost rounded to 2 dp.
    SKUs without a category or without a full cost model drop out."""
    b = revenue.join(product_cat, "product_id").join(bounded_broadcast(categories, max_rows, small), "category")
    units = F.col("units_sold").cast("decimal(20,0)")
    return b.select(
        "product_id", "category",
        round_dec(F.col("gross_revenue") * F.col("cogs_rate")).alias("cogs_total"),
        round_dec(units * F.col("storage_cost_per_unit")).alias("storage_cost_total"),
        round_dec(F.col("order_count").cast("decimal(20,0)") * F.col("fulfillment_cost_per_order"))
        .alias("fulfillment_cost_total"),
        round_dec((units * F.col("return_rate")).cast("decimal(18,4)") * F.col("return_cost_per_unit"))
        .alias("return_cost_total"),
        round_dec(F.col("freight_collected")).alias("freight_cost_total"))


def sku_reviews(base: DataFrame) -> DataFrame:
    """Per SKU average review (2 dp) and reviews scored <= 2, at item x
    review grain; only SKUs with at least one reviewed item."""
    agg = base.groupBy("product_id").agg(
        F.sum("score_sum").alias("s"), F.sum("score_n").alias("n"),
        F.sum("neg_n").alias("negative_review_count"), F.sum("reviewed_items").alias("r"))
    return agg.where(F.col("r") > 0).select(
        "product_id", round_half_up(F.col("s") / F.nullif(F.col("n"), F.lit(0)), 2).alias("avg_review_score"),
        F.col("negative_review_count").cast("long"))


PROFIT_COLUMNS = ["product_id", "category", "gross_revenue", "total_cost", "net_profit",
                  "profit_margin_pct", "avg_review_score"]


def sku_profitability(revenue: DataFrame, costs: DataFrame, reviews: DataFrame,
                      ranked: bool = True, extras: bool = False) -> DataFrame:
    """Total cost, net profit, margin %, average review, revenue rank.
    ``extras`` keeps units_sold and cogs_total (read by the decision engine)."""
    total = sum((F.col(c) for c in COST_COLUMNS[1:]), F.col(COST_COLUMNS[0]))
    df = revenue.select("product_id", "gross_revenue", "units_sold").join(costs, "product_id") \
        .join(reviews.select("product_id", "avg_review_score"), "product_id", "left") \
        .select("product_id", "category", round_dec("gross_revenue").alias("gross_revenue"),
                round_dec(total).alias("total_cost"), "avg_review_score", "units_sold", "cogs_total")
    df = df.withColumn("net_profit", round_dec(F.col("gross_revenue") - F.col("total_cost"))) \
        .withColumn("profit_margin_pct", safe_pct("net_profit", "gross_revenue", 2))
    cols = PROFIT_COLUMNS + (["units_sold", "cogs_total"] if extras else [])
    if not ranked:
        return df.select(*cols)
    order = [By("gross_revenue", desc=True), By("product_id")]
    return global_rank(df.select(*cols), order, "sku_rank").select(*cols, "sku_rank")


def classify(margin: str = "profit_margin_pct", review: str = "avg_review_score"):
    m, r = F.col(margin), F.col(review)
    return (F.when((m < 10) | (r < 3.0), "EXIT")
            .when((m >= 25) & (r >= 4.0), "SCALE")
            .otherwise("OPTIMIZE"))


def sku_class(profitability: DataFrame) -> DataFrame:
    """EXIT / SCALE / OPTIMIZE (no review and margin >= 10 -> OPTIMIZE)."""
    return profitability.withColumn("decision", classify())


def monthly_sku(base: DataFrame, product_cat: DataFrame) -> DataFrame:
    """F8: per SKU x category x month: units and revenue at item x review grain,
    average review (2 dp). Orders without a timestamp are left out."""
    return base.where(F.col("order_month").isNotNull()).join(product_cat, "product_id").select(
        "product_id", "category", "order_month",
        F.col("units_w").cast("long").alias("units_sold"),
        round_dec("revenue_w").alias("revenue"),
        round_half_up(F.col("score_sum") / F.nullif(F.col("score_n"), F.lit(0)), 2).alias("avg_review_score"))
