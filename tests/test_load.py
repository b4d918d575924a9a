"""Checked CSV loads and stored, co-partitioned tables."""
import tempfile

import pytest
from pyspark.sql import functions as F

from skuflow.plans.pipeline import Pipeline
from skuflow.sources import io, load, testdata
from skuflow.sources.schemas import RAW_SCHEMAS

from conftest import SF_SMALL

LINES = [
    "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value",
    "o1,1,p1,s1,2020-01-02 03:04:05,10.50,1.2500",
    "o2,2,p1,s1,,,",                                       # empty optional fields fit
    "o3,x,p1,s1,2020-01-02 03:04:05,1e400,1",              # two problems
    ",1,p1,s1,2020-01-02,5,1",                             # no key
    "o5,1,p1,s1,2020-02-30 00:00:00,5,1",                  # no such day
    "o6,1,p1,s1,2020-01-02 03:04:05,5",                    # too few columns
    "o7,1,p1,s1,2020-01-02 03:04:05,5,1,more",             # too many
    'o8,1,"p,1",s1,2020-01-02 03:04:05, 7 ,1',             # quoted comma, blanks around a number
    "o9,2147483648,p1,s1,,1.005,0",                        # beyond int
]


def _csv(spark, lines):
    path = tempfile.mkdtemp(prefix="skuflow-csv-") + "/order_items"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_every_record_is_a_row_or_in_quarantine(spark):
    rows, quarantine = load.read_checked(spark, _csv(spark, LINES), "order_items")
    got = {r["order_id"]: r for r in rows.collect()}
    assert set(got) == {"o1", "o2", "o8"}
    assert [f.dataType for f in rows.schema] == [f.dataType for f in RAW_SCHEMAS["order_items"]]
    assert got["o8"]["product_id"] == "p,1" and str(got["o8"]["price"]) == "7.00"
    assert got["o2"]["price"] is None and got["o2"]["shipping_limit_date"] is None
    bad = {r["line"].split(",")[0]: r["problems"] for r in quarantine.collect()}
    assert bad["o3"] == ["order_item_id: not int", "price: not decimal(18,2)"]
    assert bad[""] == ["order_id: missing"] and bad["o5"] == ["shipping_limit_date: not timestamp_ntz"]
    assert bad["o6"][0] == bad["o7"][0] == "columns: wrong number" and bad["o9"] == ["order_item_id: not int"]
    assert len(got) + quarantine.count() == len(LINES) - 1
    report = load.quarantine_report(quarantine).collect()
    assert [tuple(r) for r in report] == [("malformed_records", "order_items", 6, "fail")]


def test_read_table_refuses_what_does_not_fit(spark):
    with pytest.raises(ValueError, match="order_item_id: not int"):
        io.read_table(spark, _csv(spark, LINES[:1] + LINES[3:4]), "order_items", "csv")
    assert io.read_table(spark, _csv(spark, LINES[:3]), "order_items", "csv").count() == 2


def test_load_csv_reads_nine_tables(spark, pipe):
    root = tempfile.mkdtemp(prefix="skuflow-csv-")
    for name, df in pipe.raw.items():
        df.write.option("header", True).csv(f"{root}/{name}")
    tables, quarantine = load.load_csv(spark, root)
    assert {n: t.count() for n, t in tables.items()} == {n: t.count() for n, t in pipe.raw.items()}
    assert quarantine.count() == 0
    p = Pipeline(spark, tables, forecaster="moving_average", quarantine=quarantine)
    got, want = p.sku_revenue, pipe.sku_revenue
    assert got.select(F.col("product_id").cast("long"), "gross_revenue", "units_sold").exceptAll(want.select("product_id", "gross_revenue", "units_sold")).count() == 0
    assert got.count() == want.count()


@pytest.fixture(scope="module")
def stored(spark):
    return Pipeline.from_testdata(spark, SF_SMALL, dirty=True, gate=False, forecaster="moving_average", stored_tables=True)


def test_counts_of_the_write_are_the_report(spark, stored):
    plain = Pipeline.from_testdata(spark, SF_SMALL, dirty=True, gate=False, forecaster="moving_average")
    assert sorted(map(tuple, stored.quality_report().collect())) == sorted(map(tuple, plain.quality_report().collect()))
    for name, df in plain.cleaned.items():
        assert stored.stored.count(name, "rows") == df.count()
    raw = plain.raw["order_items"]
    assert stored.stored.count("order_items", "out_of_range:price") == raw.where("price < 0").count() > 0
    assert stored.stored.count("products", "out_of_range:product_weight_g") == plain.raw["products"].where("product_weight_g <= 0").count() > 0


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, [x for x in plan.split("\n") if "Exchange hashpartitioning" in x or "Exchange SinglePartition" in x]


def test_joins_and_key_checks_on_stored_tables_move_no_rows(spark, stored):
    from skuflow.operators import features, quality
    t = stored.cleaned
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan, moved = _exchanges(features.fact_order_items(t["order_items"], t["orders"], t["order_reviews"], ("canceled",)))
        assert plan.count("Bucketed: true") == 3 and not moved
        plan, moved = _exchanges(features.sku_month_base(t["order_items"], t["orders"], t["order_reviews"], ("canceled",)))
        assert plan.count("Bucketed: true") == 3 and all("product_id" in x for x in moved)       # only the roll-up to SKU and month
        for df in (quality.unique_key(t["orders"], ["order_id"], "orders"), quality.unique_key(t["order_items"], ["order_id", "order_item_id"], "order_items"),
                   quality.orphans(t["order_reviews"], t["orders"], "order_id", "order_id", "c", "order_reviews")):
            _, moved = _exchanges(df)
            assert all("SinglePartition" in x for x in moved)                                     # one partial sum a task
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_read_without_buckets(spark, caplog):
    orders = spark.range(6000).select(F.when(F.col("id") < 4000, 1).otherwise(F.col("id")).alias("order_id"), F.lit("shipped").alias("order_status"),
                                      F.lit("").alias("order_purchase_timestamp"))
    s = load.store_tables(spark, {"orders": orders}, buckets=8)
    assert "without buckets" in caplog.text and s.tables["orders"].count() == 6000
    assert "Bucketed: true" not in s.tables["orders"].groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
    assert s.count("orders", "null:order_purchase_timestamp") == 6000


def test_release_drops_tables_and_files(spark):
    from pathlib import Path
    s = load.store_tables(spark, {k: v for k, v in testdata.load_tables(spark, SF_SMALL).items() if k in ("orders", "storage_costs")})
    paths, names = [Path(p.removeprefix("file:")) for p in s.written], list(s.names)
    assert all(p.exists() for p in paths) and spark.catalog.tableExists(names[0])
    s.release()
    assert not any(p.exists() for p in paths) and not spark.catalog.tableExists(names[0])
