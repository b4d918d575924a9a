"""Rounding, formatting, classification and verdict branches on literal frames."""
from decimal import Decimal

from pyspark.sql import functions as F

from skuflow.functions.columns import dominant, money, pct_text, round_half_up
from skuflow.operators.features import classify
from skuflow.operators.inventory import verdict
from skuflow.params import InventoryParams


def test_round_half_up_ties_away_from_zero(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.5,), (1.005,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got[:3] == [Decimal("0.13"), Decimal("-0.13"), Decimal("2.50")]
    assert got[4] is None
    ints = [r[0] for r in df.select(round_half_up("x", 0)).collect()]
    assert ints[2] == 3


def test_money_and_pct_text(spark):
    df = spark.createDataFrame([(Decimal("-1234567.5"),), (Decimal("0"),)], "x decimal(18,2)")
    assert [r[0] for r in df.select(money("x")).collect()] == ["$-1,234,567.50", "$0.00"]
    assert [r[0] for r in df.select(pct_text(F.col("x") / 100)).collect()] == ["-12345.7%", "0.0%"]


def test_dominant_tie_order(spark):
    df = spark.createDataFrame([(5, 5, 1), (1, 2, 2), (None, 1, 3)], "a int, b int, c int")
    got = [r[0] for r in df.select(dominant([("a", "A"), ("b", "B"), ("c", "C")])).collect()]
    assert got == ["A", "B", "C"]


def test_classification_branches(spark):
    rows = [(9.99, 4.5), (10.0, 2.99), (10.0, 3.0), (25.0, 4.0), (24.99, 5.0), (30.0, None), (5.0, None),
            (None, None), (None, 2.0)]
    df = spark.createDataFrame(rows, "profit_margin_pct double, avg_review_score double")
    got = [r[0] for r in df.select(classify()).collect()]
    assert got == ["EXIT", "EXIT", "OPTIMIZE", "SCALE", "OPTIMIZE", "OPTIMIZE", "EXIT", "OPTIMIZE", "EXIT"]


def test_verdict_edges(spark):
    p = InventoryParams()
    rows = [  # forecast, margin, stock, rop
        (0.5, 5.0, 10.0, 1.0),     # dead and thin -> DISCONTINUE first
        (0.5, None, 0.0, 0.0),     # NULL margin never discontinues; stock 0 = ROP 0 -> REORDER NOW
        (2.0, 50.0, 1.0, 0.0),     # ROP 0, stock > 0 -> REDUCE STOCK
        (2.0, 50.0, 4.0, 4.0),     # stock == ROP -> REORDER NOW
        (2.0, 50.0, 12.0, 4.0),    # stock == 3 x ROP -> HOLD
        (2.0, 50.0, 12.01, 4.0),   # above 3 x ROP -> REDUCE STOCK
    ]
    df = spark.createDataFrame(rows, "forecast_demand double, profit_margin_pct double, "
                                     "modeled_current_stock double, reorder_point double")
    got = [r[0] for r in df.select(verdict(p)).collect()]
    assert got == ["DISCONTINUE", "REORDER NOW", "REDUCE STOCK", "REORDER NOW", "HOLD", "REDUCE STOCK"]


def test_exact_ties_round_away_from_zero(spark):
    from skuflow.functions.columns import exact_avg, exact_div
    df = spark.createDataFrame([(Decimal("924238.14"), 28), (Decimal("-924238.14"), 28), (Decimal("1.00"), 3), (Decimal("5.00"), 0), (None, 4)],
                               "x decimal(18,2), n long")
    got = [r[0] for r in df.select(exact_div("x", "n")).collect()]
    assert got == [Decimal("33008.51"), Decimal("-33008.51"), Decimal("0.33"), None, None]
    half = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),)], "x decimal(12,2)")
    assert half.select(exact_avg("x", 2), exact_avg("x", 6)).first() == (Decimal("0.02"), Decimal("0.015000"))
