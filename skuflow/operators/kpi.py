"""KPI views (K1, K3-K6; K2 lives with the inventory operators it reads)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuflow.functions.columns import as_double, round_dec, round_half_up, valid_orders
from skuflow.operators.features import month_of, review_stats_by_order


def _avg2(col: str):
    return round_half_up(as_double(F.sum(col)) / F.nullif(as_double(F.count(col)), F.lit(0.0)), 2)


def portfolio_kpis(classified: DataFrame) -> DataFrame:
    """K1: one row. product_id is the key of F7b, so counting it counts distinct SKUs."""
    d = F.col("decision")
    return classified.agg(
        F.count("product_id").alias("total_skus_analyzed"),
        round_dec(F.sum("gross_revenue"), 2, 38).alias("total_gross_revenue"),
        round_dec(F.sum("net_profit"), 2, 38).alias("total_net_profit"),
        _avg2("profit_margin_pct").alias("avg_profit_margin_pct"),
        _avg2("avg_review_score").alias("avg_customer_review"),
        F.count_if(d == "SCALE").alias("scale_skus"),
        F.count_if(d == "OPTIMIZE").alias("optimize_skus"),
        F.count_if(d == "EXIT").alias("exit_skus"))


def monthly_revenue(items: DataFrame, orders: DataFrame, excluded: Iterable[str]) -> DataFrame:
    """K3: per month distinct orders, units, revenue, freight and average item price."""
    vo = valid_orders(orders, excluded).where(F.col("order_purchase_timestamp").isNotNull()) \
        .select("order_id", month_of().alias("order_month"))
    lines = items.select("order_id", "price", "freight_value").join(vo.hint("merge"), "order_id")
    return lines.groupBy("order_month").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.count(F.lit(1)).alias("units_sold"),
        round_dec(F.sum("price"), 2, 38).alias("gross_revenue"),
        round_dec(F.sum("freight_value"), 2, 38).alias("freight_collected"),
        round_half_up(as_double(F.sum("price")) / F.nullif(as_double(F.count("price")), F.lit(0.0)), 2)
        .alias("avg_order_value"))


def top_skus(classified: DataFrame, n: int = 400) -> DataFrame:
    """K4: the ``n`` highest-revenue SKUs with their rank (top-k, then a rank
    over at most ``n`` rows)."""
    order = [F.col("gross_revenue").desc_nulls_last(), F.col("product_id").asc_nulls_last()]
    top = classified.orderBy(*order).limit(n)
    return top.withColumn("sku_rank", F.row_number().over(Window.orderBy(*order)).cast("long")).select(
        "product_id", "category", "gross_revenue", "total_cost", "net_profit", "profit_margin_pct",
        "avg_review_score", "sku_rank", "decision")


def top_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """K5: revenue by product over all order statuses (aggregate, then join)."""
    per = items.groupBy("product_id").agg(F.count(F.lit(1)).alias("total_items_sold"),
                                          F.sum("price").alias("revenue"))
    return per.join(products.select("product_id", "product_category_name"), "product_id").select(
        "product_id", "product_category_name", "total_items_sold", round_dec("revenue", 2, 38).alias("revenue"))


def worst_rated(items: DataFrame, orders: DataFrame, reviews: DataFrame, products: DataFrame,
                n: int = 5) -> DataFrame:
    """K6: the ``n`` lowest-rated PT categories at item x review grain, all
    statuses; a NULL category is its own group. Reviews are pre-aggregated per
    order, items per product, before the category rollup."""
    per_order = review_stats_by_order(reviews).join(orders.select("order_id"), "order_id", "left_semi")
    per_product = items.select("order_id", "product_id").join(per_order.hint("merge"), "order_id") \
        .groupBy("product_id").agg(
        F.sum("score_sum").alias("s"), F.sum("score_n").alias("c"), F.sum("n_review_ids").alias("r"))
    per_cat = per_product.join(products.select("product_id", "product_category_name"), "product_id") \
        .groupBy("product_category_name").agg(F.sum("s").alias("s"), F.sum("c").alias("c"), F.sum("r").alias("r"))
    out = per_cat.select(
        "product_category_name",
        round_half_up(as_double("s") / F.nullif(as_double("c"), F.lit(0.0)), 2).alias("avg_rating"),
        F.col("r").cast("long").alias("total_reviews"))
    return out.orderBy(F.col("avg_rating").asc_nulls_last(), F.col("product_category_name").asc_nulls_last()).limit(n)
