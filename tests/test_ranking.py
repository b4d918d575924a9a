"""Ranks, running totals, selections and medians over value ranges equal the single-partition SQL windows."""
import datetime as dt
import random
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from skuflow.functions.ranking import _TIE_BITS, By, ValueRanges, _below, global_rank, global_running, medians, nth_row


def _frame(spark, n=3000, distinct=40, seed=7):
    rnd = random.Random(seed)
    rows = [(i, Decimal(rnd.randrange(distinct)) / 4) for i in range(n)]
    return spark.createDataFrame(rows, "id long, v decimal(18,2)").repartition(8)


def _mixed(spark, seed=3, n=1500):
    """Every key type, nulls, extremes, and one value of each that holds about half of all rows."""
    rnd = random.Random(seed)
    day = dt.date(2020, 1, 1)
    rows = []
    for i in range(n):
        hot = rnd.random() < 0.5
        v = 7 if hot else rnd.choice([None, rnd.randrange(-50, 50), 10 ** 12])
        rows.append((i, f"SKU-{i * 7919 % n:06d}", None if v is None else Decimal(v) / 4, None if v is None else float(v) if v < 1000 else rnd.choice([float("nan"), float("inf"), -0.0]),
                     None if v is None else f"{'pre' if v % 2 else 'prefix'}é{v}", None if v is None else day + dt.timedelta(days=v % 400),
                     None if v is None else dt.datetime(2020, 1, 1) + dt.timedelta(seconds=v % 9000), None if v is None else v % 3 == 0))
    return spark.createDataFrame(rows, "id long, sku string, dec decimal(18,2), dbl double, txt string, day date, ts timestamp, flag boolean").repartition(5)


@pytest.mark.parametrize("column,desc,nulls_first", [
    ("dec", True, False), ("dec", False, True), ("dbl", True, True), ("dbl", False, False), ("txt", True, False), ("txt", False, True),
    ("day", False, True), ("ts", True, True), ("flag", True, False), ("sku", False, False)])
def test_global_rank_matches_row_number(spark, column, desc, nulls_first):
    df = _mixed(spark)
    order = [By(column, desc, nulls_first), By("id", desc=not desc) if nulls_first else By("sku")]
    ours = {r["id"]: r["rk"] for r in global_rank(df, order, "rk").collect()}
    w = Window.orderBy(*[b.order() for b in order])
    assert ours == {r["id"]: r["rk"] for r in df.select("id", F.row_number().over(w).alias("rk")).collect()}


def test_running_sums(spark):
    df = _frame(spark)
    order = [By("v", desc=True), By("id")]
    got = global_running(df, "v", order, "cum", "rk", "run")
    ours = {r["id"]: (r["cum"], r["rk"], r["run"]) for r in got.collect()}
    w = Window.orderBy(*[b.order() for b in order])
    peers = Window.orderBy(order[0].order())            # default RANGE frame: peers share the total
    ref = df.select("id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"), F.row_number().over(w).alias("r"), F.sum("v").over(peers).alias("p"))
    assert ours == {r["id"]: (r["c"], r["r"], r["p"]) for r in ref.collect()}
    assert got.columns == ["id", "v", "cum", "rk", "run"]


def test_equal_keys_share_a_range_unless_they_fill_several(spark):
    df = _frame(spark, n=4000, distinct=400).withColumn("v", F.when(F.col("id") % 3 == 0, 1000).otherwise(F.col("v")).cast("decimal(18,2)"))
    rows = ValueRanges(df, [By("v"), By("id")], parts=12).rows
    per_value = rows.groupBy("v").agg(F.count_distinct("_range").alias("ranges"), F.count(F.lit(1)).alias("n")).collect()
    assert {r["v"] for r in per_value if r["ranges"] > 1} == {Decimal("1000.00")}
    largest = max(r["n"] for r in rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect())
    assert largest < 4000 / 12 * 3                      # the third of the rows with one value does not share a range
    keys = [r[0] for r in rows.select(F.shiftright("_range", _TIE_BITS).alias("k"), "v").distinct().orderBy("v", "k").select("k").collect()]
    assert keys == sorted(keys)


def test_ranks_store_nothing(spark, tmp_path):
    from pathlib import Path
    from skuflow.session import ensure_checkpoint_dir
    root = Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "skuflow-stages"
    before = set(root.glob("*")) if root.exists() else set()
    global_rank(_frame(spark), [By("v"), By("id")], "rk").collect()
    nth_row(_frame(spark), [By("v"), By("id")], 17).collect()
    assert (set(root.glob("*")) if root.exists() else set()) == before


def test_rank_plan_has_no_global_sort_or_single_partition_of_rows(spark):
    plan = global_rank(_frame(spark), [By("v"), By("id")], "rk")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("SinglePartition") == 1      # the per-range totals


@pytest.mark.parametrize("n", [0, 1, 5, 6, 7, 35, 36, 37, 38, 200])
def test_below_counts(spark, n):
    bounds = [float(3 * i) for i in range(n)]
    codes = [-1.0, 0.0, 0.5, 3.0, 10.0, 1.5 * n, 3.0 * n, 1e9, float("-inf"), float("inf")]
    df = spark.createDataFrame([(c,) for c in codes], "c double")
    assert [r[0] for r in df.select(_below(bounds, F.col("c"))).collect()] == [sum(b < c for b in bounds) for c in codes]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=6)), min_size=1, max_size=60))
def test_nth_row_property(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v long").repartition(3)
    order = [By("v", desc=True), By("id")]
    want = [r["id"] for r in df.orderBy(*[b.order() for b in order]).collect()]
    for n in (1, len(values) // 2 + 1, len(values)):
        assert [r["id"] for r in nth_row(df, order, n).collect()] == [want[n - 1]]
    assert nth_row(df, order, len(values) + 1).collect() == []


def test_empty_and_single(spark):
    none = spark.createDataFrame([], "id long, v string")
    order = [By("v"), By("id")]
    assert global_rank(none, order, "rk").collect() == [] and nth_row(none, order, 1).collect() == []
    one = spark.createDataFrame([(1, None)], "id long, v string")
    assert global_rank(one, order, "rk").first()["rk"] == 1
    assert global_running(one, "id", order, "s", "rk", "p").first()[2:] == (1, 1, 1)


def _middle(values):
    v = sorted(values)
    return (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2 if v else None


@pytest.mark.parametrize("few", [False, True])
def test_medians_of_groups_and_columns(spark, few):
    rnd = random.Random(9)
    rows = []
    for _ in range(4000):
        g = rnd.choice(["a", "a", "b", None, "one", "void"])
        rows.append((g, None if g == "void" or rnd.random() < 0.1 else Decimal(rnd.choice([rnd.randrange(-10 ** 6, 10 ** 6), 500])) / 100,
                     rnd.choice([None, rnd.randrange(9), 10 ** 17 + rnd.randrange(100)])))
    rows = [r for i, r in enumerate(rows) if r[0] != "one" or i < 6] + [("pair", Decimal("1.01"), 1), ("pair", Decimal("1.02"), 4)]
    df = spark.createDataFrame(rows, "g string, x decimal(12,2), n long").repartition(7)
    got = {r["g"]: (r["x"], r["n"]) for r in medians(df, ["g"], {"x": (F.col("x"), 2), "n": (F.col("n"), 0)}, few).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        want[g] = (_middle([r[1] for r in rows if r[0] == g and r[1] is not None]), _middle([Decimal(r[2]) for r in rows if r[0] == g and r[2] is not None]))
    assert got == want and got["pair"] == (Decimal("1.015"), Decimal("2.5"))


def test_medians_without_groups(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in ("1.00", "2.00", "4.50", "9.00")], "x decimal(12,2)")
    assert medians(df, [], {"m": (F.col("x"), 2)}).first()[0] == Decimal("3.25")
    assert medians(df.where("x < 9"), [], {"m": (F.col("x"), 2), "none": (F.when(F.col("x") > 100, F.col("x")), 2)}).first()[:] == (Decimal("2.00"), None)
    assert medians(df.where("x > 9"), [], {"m": (F.col("x"), 2)}).collect() == [(None,)]
    assert medians(df.where("x > 9").withColumn("g", F.lit(1)), ["g"], {"m": (F.col("x"), 2)}).collect() == []


def test_median_counts_only_the_bracket(spark):
    """Far more distinct values than the sketch keeps: the counting stage sees a thousandth of them."""
    df = spark.range(400_000).select((F.col("id") * 7919 % 400_000).alias("x"))
    assert medians(df, [], {"m": (F.col("x"), 0)}).first()[0] == Decimal("199999.5")
    assert medians(df.where("x < 399999"), [], {"m": (F.col("x"), 0)}).first()[0] == Decimal("199999.0")
