"""Sources and sinks (S1-S4): round trips through files."""
import tempfile

from pyspark.sql import functions as F

from skuflow.sources import io
from skuflow.sources.schemas import FORECAST_SCHEMA, check_schema


def test_forecast_and_series_round_trip(spark, pipe):
    root = tempfile.mkdtemp(prefix="skuflow-io-")
    fc = pipe.forecast_table()
    io.write_forecasts(fc, f"{root}/forecasts")
    back = io.read_forecasts(spark, f"{root}/forecasts")
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in FORECAST_SCHEMA]
    assert back.exceptAll(fc.select(*back.columns)).count() == 0
    assert back.where(F.col("grain") == "sku").count() == fc.where(F.col("grain") == "sku").count()

    io.write_demand_series(pipe.monthly_sku, f"{root}/series")
    series = io.read_demand_series(spark, f"{root}/series")
    assert series.columns == ["product_id", "category", "order_month", "units_sold"]
    assert series.agg(F.sum("units_sold")).collect()[0][0] == pipe.monthly_sku.agg(F.sum("units_sold")).collect()[0][0]


def test_read_table_checks_schema(spark, pipe):
    root = tempfile.mkdtemp(prefix="skuflow-io-")
    pipe.raw["orders"].write.parquet(f"{root}/orders")
    df = io.read_table(spark, f"{root}/orders", "orders")
    assert df.count() == pipe.raw["orders"].count()
    try:
        check_schema(df.drop("order_status"), "orders")
    except ValueError as e:
        assert "order_status" in str(e)
    else:
        raise AssertionError("missing column not reported")


def test_pipeline_from_an_external_series_and_from_stored_forecasts(spark, pipe):
    from skuflow.plans.pipeline import Pipeline
    root = tempfile.mkdtemp(prefix="skuflow-io-")
    series = pipe.monthly_sku.select("product_id", "category", F.concat("order_month", F.lit("-01")).alias("order_month"), "units_sold")
    series.write.option("header", True).csv(f"{root}/s")
    own = Pipeline.from_demand_series(spark, io.read_demand_series(spark, f"{root}/s"), forecaster="moving_average")
    a, b = own.forecast_table(), pipe.forecast_table()
    assert a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count()
    io.write_forecasts(b, f"{root}/f")
    stored = Pipeline.from_forecasts(spark, pipe.raw, io.read_forecasts(spark, f"{root}/f"))
    assert stored.sku_decisions().exceptAll(pipe.sku_decisions()).count() == 0


def test_stages_need_a_shared_folder_on_a_cluster():
    import pytest

    from skuflow.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_release_deletes_stored_stages(spark):
    import os

    from skuflow.plans.pipeline import Pipeline

    from conftest import SF_SMALL
    own = Pipeline.from_testdata(spark, SF_SMALL, forecaster="moving_average")
    own.monthly_sku
    paths = [p.removeprefix("file:") for p in own._written]
    assert paths and all(os.path.isdir(p) for p in paths)
    own.release()
    assert not any(os.path.isdir(p) for p in paths)
