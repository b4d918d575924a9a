"""Forecast trust reports (V1-V5)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuflow.functions.columns import as_double, exact_avg, money, opportunity, round_dec, round_half_up
from skuflow.functions.ranking import latest_per_key, medians, modal_value, scorecard

# Published baseline rows of the model comparison.
BASELINE_ROWS = [
    (1, "Naive (last-value)", Decimal("3.20"), Decimal("95.0"), False, False,
     "Carries last observed value forward; no trend, no uncertainty."),
    (2, "3-month Moving Average", Decimal("2.80"), Decimal("82.0"), False, False,
     "Smooths recent demand; still no trend term or confidence bands."),
]
#: The row of the model that made the forecasts, by how its name begins: label, trend, bands, note.
SELECTED = {
    "HW": ("Holt-Winters (selected)", True, True,
                     "Selected model: best MAE, models trend, produces confidence bands and labels."),
    "MA-3": ("3-month Moving Average (selected)", False, True,
             "Selected model: flat 3-month mean with bands from its past errors; no trend term."),
}
GRADES = ((20, "Strong"), (50, "Moderate"))
GRADE_ELSE = "Weak"
THRESHOLDS = {"high": "MAPE < 20%", "medium": "MAPE 20–50%", "low": "MAPE > 50%"}
BANDS = (("high", "High"), ("medium", "Medium"), ("low", "Low"))


def _avg(c: str, n: int) -> Column:
    return exact_avg(c, n)


def category_accuracy(forecasts: DataFrame) -> DataFrame:
    """V1: category-grain accuracy and grade (a NULL average grades Weak)."""
    s, n = F.sum("mape_pct"), F.count("mape_pct")
    grade = F.when(s < n * GRADES[0][0], GRADES[0][1]).when(s < n * GRADES[1][0], GRADES[1][1]) \
        .otherwise(GRADE_ELSE)
    return forecasts.where(F.col("grain") == "category").groupBy("category").agg(
        F.max("model_used").alias("model_used"), _avg("mape_pct", 2).alias("mape_pct"), _avg("mae", 2).alias("mae"),
        F.max("confidence").alias("confidence"), F.count(F.lit(1)).alias("forecast_months"),
        round_dec(F.sum("predicted_units"), 2, 38).alias("total_forecast_units"), grade.alias("accuracy_grade"))


def _with_totals(per_band: DataFrame, cols: list[str]) -> DataFrame:
    """Totals over the bands: the per-band frame has one row per confidence
    label (a handful), so an un-partitioned window over it is trivial."""
    w = Window.partitionBy()
    return per_band.select("*", *[F.sum(c).over(w).alias(f"_tot_{c}") for c in cols])


def reliability_by_band(decisions: DataFrame, profitability: DataFrame) -> DataFrame:
    """V2: SKUs, revenue and money at stake per confidence band, with shares."""
    b = decisions.join(profitability.select("product_id", "gross_revenue"), "product_id") \
        .withColumn("_opp", opportunity())
    agg = b.groupBy("confidence").agg(F.count(F.lit(1)).alias("sku_count"),
                                      round_dec(F.sum("gross_revenue"), 2, 38).alias("revenue_brl"),
                                      round_dec(F.sum("_opp"), 2, 38).alias("opportunity_brl"))
    t = _with_totals(agg, ["sku_count", "opportunity_brl"])
    return t.select(
        "confidence", "sku_count",
        round_half_up(as_double("sku_count") * 100.0 / as_double("_tot_sku_count"), 1).alias("pct_of_skus"),
        "revenue_brl", "opportunity_brl",
        round_half_up(as_double("opportunity_brl") * 100.0 / F.nullif(as_double("_tot_opportunity_brl"), F.lit(0.0)),
                      1).alias("pct_of_opportunity"))


def latest_sku_rows(forecasts: DataFrame) -> DataFrame:
    """The latest forecast row per SKU (DISTINCT ON grain_key ... month DESC)."""
    return latest_per_key(forecasts.where(F.col("grain") == "sku"), ["grain_key"], "forecast_month",
                          ["category", "confidence", "mape_pct", "mae", "model_used"])


def _median_errors(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys (labels) with the rounded medians of MAE and MAPE."""
    return medians(df, keys, {"mae": (F.col("mae"), 2), "mape_pct": (F.col("mape_pct"), 2)}, few=True).select(
        *keys, F.round("mae", 2).cast("decimal(18,2)").alias("median_mae"), F.round("mape_pct", 1).cast("decimal(18,1)").alias("median_mape_pct"))


def model_comparison(forecasts: DataFrame, baselines: DataFrame | None = None) -> DataFrame:
    """V3: naive and moving-average rows (published figures, or live medians
    when ``baselines`` (M16) is given) and the live medians of the model that made
    the forecasts, labelled by ``model_used``."""
    s = latest_sku_rows(forecasts)
    hw = _median_errors(s, []).withColumn("used", s.agg(F.max("model_used")).scalar())

    def of_model(i: int) -> Column:
        expr = F.lit(None)
        for name, row in SELECTED.items():
            expr = F.when(F.col("used").startswith(name), F.lit(row[i])).otherwise(expr)
        return expr

    sel = hw.select(F.lit(3).alias("sort_order"), F.coalesce(of_model(0), "used").alias("model"), "median_mae", "median_mape_pct",
                    of_model(1).alias("captures_trend"), of_model(2).alias("confidence_bands"), of_model(3).alias("notes"))
    if baselines is None:
        rows = [hw.select(F.lit(i).alias("sort_order"), F.lit(m).alias("model"),
                          F.lit(mae).cast("decimal(18,2)").alias("median_mae"),
                          F.lit(mape).cast("decimal(18,1)").alias("median_mape_pct"),
                          F.lit(t).alias("captures_trend"), F.lit(b).alias("confidence_bands"),
                          F.lit(n).alias("notes"))
                for i, m, mae, mape, t, b, n in BASELINE_ROWS]
        base = rows[0].unionByName(rows[1])
    else:
        notes = {m: (i, n) for i, m, _, _, _, _, n in BASELINE_ROWS}
        live = _median_errors(baselines.where(F.col("grain") == "sku"), ["model"])
        so = F.lit(9)
        nt = F.lit(None).cast("string")
        for m, (i, n) in notes.items():
            so = F.when(F.col("model") == m, i).otherwise(so)
            nt = F.when(F.col("model") == m, n).otherwise(nt)
        base = live.select(so.alias("sort_order"), "model", "median_mae", "median_mape_pct",
                           F.lit(False).alias("captures_trend"), F.lit(False).alias("confidence_bands"),
                           nt.alias("notes"))
    return base.unionByName(sel)


def _pct1(num: Column, den: Column) -> Column:
    return round_half_up(as_double(num) * 100.0 / F.nullif(as_double(den), F.lit(0.0)), 1)


def _pct_display(x: Column) -> Column:
    return F.concat(x.cast("decimal(18,1)").cast("string"), F.lit("%"))


def confidence_scorecard(forecasts: DataFrame, decisions: DataFrame, currency: str = "R$") -> DataFrame:
    """V4: 19 long-form metrics per confidence band; rows of an empty band are absent."""
    s = latest_sku_rows(forecasts)
    c = F.col("confidence")
    band_aggs = []
    for key, _ in BANDS:
        band_aggs.append(F.count_if(c == key).alias(f"n_{key}"))
    middle = medians(s, [], {"med_all": (F.col("mape_pct"), 2),
                             **{f"med_{key}": (F.when(c == key, F.col("mape_pct")), 2) for key, _ in BANDS}})
    packed_medians = middle.select(F.struct(*[F.round(m, 1).alias(m) for m in middle.columns])).scalar()
    b = s.agg(F.count(F.lit(1)).alias("total_skus"),
              F.sum(F.when(c.isin("high", "medium"), 1)).alias("high_med_skus"), *band_aggs) \
        .withColumns({m: packed_medians.getField(m) for m in middle.columns})
    o = decisions.withColumn("_opp", opportunity()).groupBy("confidence").agg(
        round_dec(F.sum("_opp"), 2, 38).alias("opp"))
    oa_cols = [F.sum("opp").alias("total_opp"),
               *[F.sum(F.when(c == key, F.col("opp"))).alias(f"opp_{key}") for key, _ in BANDS],
               *[F.count_if(c == key).alias(f"has_opp_{key}") for key, _ in BANDS]]
    # one scalar subquery returning a struct: computed once, no join
    packed = o.agg(F.struct(*oa_cols).alias("s")).scalar()
    names = ["total_opp"] + [f"opp_{k}" for k, _ in BANDS] + [f"has_opp_{k}" for k, _ in BANDS]
    row = b.withColumns({n: packed.getField(n) for n in names})
    metrics = []
    sort = 1
    for key, title in BANDS:
        n, med, opp = F.col(f"n_{key}"), F.col(f"med_{key}"), F.col(f"opp_{key}")
        has_band, has_opp = n > 0, F.col(f"has_opp_{key}") > 0
        share = _pct1(n, F.col("total_skus"))
        oshare = _pct1(opp, F.col("total_opp"))
        metrics += [
            (sort, f"{title}-confidence SKUs (count)", n, n.cast("string"), has_band),
            (sort + 1, f"{title}-confidence SKUs (% of total)", share, _pct_display(share), has_band),
            (sort + 2, f"{title}-confidence — median MAPE", med, _pct_display(med), has_band),
            (sort + 3, f"{title}-confidence — opportunity (BRL)", opp, money(opp, currency), has_opp),
            (sort + 4, f"{title}-confidence — % of total opportunity", oshare, _pct_display(oshare), has_opp),
        ]
        sort += 5
    hm = F.col("high_med_skus")
    hm_share = _pct1(hm, F.col("total_skus"))
    metrics += [
        (16, "High + Medium SKUs (actionable confidence)", hm, hm.cast("string")),
        (17, "High + Medium share of total SKUs", hm_share, _pct_display(hm_share)),
        (18, "Median MAPE — High-confidence SKUs only", F.col("med_high"), _pct_display(F.col("med_high")),
         F.col("n_high") > 0),
        (19, "Median MAPE — all forecastable SKUs", F.col("med_all"), _pct_display(F.col("med_all"))),
    ]
    return scorecard(row, metrics, "decimal(38,2)").select("metric", "value", "value_display")


def confidence_coverage(forecasts: DataFrame) -> DataFrame:
    """V5: each category's effective confidence (the modal confidence of its
    SKUs, ties high < medium < other, else the category forecast's own) and
    coverage type, counted per confidence."""
    sku = latest_sku_rows(forecasts).select("category", "confidence")
    dominant = modal_value(sku, "category", "confidence",
                           F.when(F.col("confidence") == "high", 1).when(F.col("confidence") == "medium", 2)
                           .otherwise(3), "sku_conf")
    cat = latest_per_key(forecasts.where(F.col("grain") == "category"), ["grain_key"], "forecast_month",
                         ["confidence"]).select(F.col("grain_key").alias("category"), "confidence")
    eff = cat.join(dominant, "category", "left").select(
        "category", F.when(F.col("sku_conf").isNotNull(), "sku-forecast").otherwise("category-only").alias("cov"),
        F.coalesce("sku_conf", "confidence").alias("confidence"))
    thr = None
    for k, text in THRESHOLDS.items():
        thr = F.when(F.col("confidence") == k, text) if thr is None else thr.when(F.col("confidence") == k, text)
    agg = eff.groupBy("confidence").agg(
        F.count(F.lit(1)).alias("category_count"),
        F.count_if(F.col("cov") == "sku-forecast").alias("categories_with_sku_forecast"),
        F.count_if(F.col("cov") == "category-only").alias("categories_category_only"))
    t = _with_totals(agg, ["category_count"])
    return t.select(
        "confidence", thr.alias("mape_threshold"), "category_count",
        round_half_up(as_double("category_count") * 100.0 / F.nullif(as_double("_tot_category_count"), F.lit(0.0)), 1)
        .alias("pct_of_categories"), "categories_with_sku_forecast", "categories_category_only")
