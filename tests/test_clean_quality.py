"""Cleaning keeps every row; the quality report finds the injected defects."""
import pytest
from pyspark.sql import functions as F

from skuflow.operators import clean, quality
from skuflow.plans.pipeline import Pipeline
from skuflow.sources import testdata

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def dirty(spark):
    return testdata.load_tables(spark, SF_SMALL, dirty=True)


def test_cleaning_preserves_rows_and_fixes_values(spark, dirty):
    cleaned = clean.clean_tables(dirty)
    for name, df in dirty.items():
        assert cleaned[name].count() == df.count(), name
    o = cleaned["orders"]
    assert o.where(F.col("order_status") != F.lower(F.trim("order_status"))).count() == 0
    assert o.where(F.col("order_purchase_timestamp").isNull()).count() > 0      # '' became NULL
    assert dict(o.dtypes)["order_purchase_timestamp"].startswith("timestamp")
    items = cleaned["order_items"]
    assert items.where(F.col("price") < 0).count() == 0
    assert items.where(F.col("price").isNull()).count() > 0
    p = cleaned["products"]
    assert "product_name_length" in p.columns and "product_name_lenght" not in p.columns
    assert p.where(F.col("product_weight_g") <= 0).count() == 0
    assert cleaned["supplier_costs"].where(F.col("category") != F.lower(F.trim("category"))).count() == 0


def test_cleaning_is_idempotent(spark, dirty):
    once = clean.clean_tables(dirty)
    twice = clean.clean_tables(once)
    for name in once:
        assert once[name].exceptAll(twice[name]).count() == 0, name


def test_quality_report_and_gate(spark, dirty):
    t = clean.clean_tables(dirty)
    rep = {r["check"]: r["violations"] for r in quality.quality_report(t).collect()}
    assert rep["orphan_items_product_missing"] > 0
    assert rep["null_purchase_timestamp"] > 0
    assert rep["null_product_category"] > 0
    assert rep["unexpected_order_status"] == 0
    assert rep["cost_coverage_missing"] == 1
    with pytest.raises(quality.DataQualityError):
        quality.enforce(quality.quality_report(t))
    for stage in ("dim_category", "base", "sku_revenue", "monthly_sku", "profitability"):
        with pytest.raises(quality.DataQualityError):
            getattr(Pipeline(spark, dirty), stage)
    assert Pipeline(spark, dirty).quality_report().count() == 6     # the report itself stays readable


def test_key_report_flags_duplicate_item_keys(pipe):
    rep = {r["check"]: r["violations"] for r in pipe.key_report().collect()}
    assert rep["pk_order_items"] > 0          # (order, line) is not unique in the driver data
    assert rep["pk_orders"] == 0 and rep["pk_products"] == 0
    assert rep["fk_products_product_category_name"] == 0


def test_key_report_needs_every_table(pipe):
    t = {**pipe.cleaned, "forecast_results": pipe.forecasts}
    assert quality.key_report(t).count() == 16
    for name in ("order_reviews", "forecast_results"):
        with pytest.raises(quality.DataQualityError, match=name):
            quality.key_report({k: v for k, v in t.items() if k != name})


def test_wall_clock_times_inside_a_clock_change_stay(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2021-03-14 02:30:00",), ("",), ("junk",)], "ts string")
        got = [r[0] for r in clean.blank_to_null(df, ["ts"]).select(F.col("ts").cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2021-03-14 02:30:00", None, None]
