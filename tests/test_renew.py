"""Renewal of stored forecasts: changed series only, the rest untouched."""
import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from skuflow.operators import demand, forecast, renew
from skuflow.params import ForecastParams

P = ForecastParams(fixed_weights=(0.3, 0.1, 0.1))


def _series(pipe, n=40):
    keys = [r[0] for r in pipe.filled_series.where("grain = 'sku'").select("grain_key").distinct().orderBy("grain_key").limit(n).collect()]
    return pipe.filled_series.where(F.col("grain_key").isin(keys)), keys


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def _renewed(spark, path, filled, model="m", p=P, fitted=None):
    def fit(series):
        if fitted is not None:
            fitted.update(r[0] for r in series.select("grain_key").distinct().collect())
        return forecast.holt_winters(series, p)
    return renew.renew_forecasts(filled, path, fit, model, p, buckets=16)


def test_refit_of_changed_series_equals_a_full_refit(spark, pipe):
    path = tempfile.mkdtemp(prefix="skuflow-renew-") + "/store"
    filled, keys = _series(pipe)
    first = _renewed(spark, path, filled)
    assert first.fitted == len(keys) and (first.removed, first.unchanged) == (0, 0)
    before, files = _rows(renew.read_renewed(spark, path)), _files(path)
    assert before == _rows(forecast.holt_winters(filled, P).select(*renew._COLUMNS))

    again = _renewed(spark, path, filled)
    assert again == renew.Renewal(0, 0, len(keys), 0) and _files(path) == files      # nothing to do, nothing written

    changed, gone = keys[3:6], keys[7]
    now = filled.where(F.col("grain_key") != gone).withColumn("units", F.when(F.col("grain_key").isin(changed) & (F.col("t") == 5), F.col("units") + 9).otherwise(F.col("units")))
    fitted = set()
    done = _renewed(spark, path, now, fitted=fitted)
    assert fitted == set(changed) and done.fitted == 3 and done.removed == 1 and done.unchanged == len(keys) - 4
    after = _rows(renew.read_renewed(spark, path))
    assert after == _rows(forecast.holt_winters(now, P).select(*renew._COLUMNS))
    same = {r for r in before if r[1] not in changed and r[1] != gone}
    assert same <= set(after)
    rewritten = {f.rsplit("/", 1)[0] for f in set(_files(path)) - set(files)}
    assert len(rewritten) <= done.partitions <= 4


def test_other_settings_refit_everything_and_emptied_partitions_go(spark, pipe):
    path = tempfile.mkdtemp(prefix="skuflow-renew-") + "/store"
    filled, keys = _series(pipe, 6)
    _renewed(spark, path, filled)
    other = ForecastParams(fixed_weights=(0.5, 0.1, 0.1))
    assert _renewed(spark, path, filled, p=other).fitted == 6
    left = filled.where(F.col("grain_key") == keys[0])
    done = _renewed(spark, path, left, p=other)
    assert done.removed == 5 and done.fitted == 0
    assert _rows(renew.read_renewed(spark, path)) == _rows(forecast.holt_winters(left, other).select(*renew._COLUMNS))
    assert len({f.rsplit("/", 1)[0] for f in _files(path)}) == 1


def test_pipeline_store_feeds_decisions(spark, pipe):
    from skuflow.plans.pipeline import Pipeline
    path = tempfile.mkdtemp(prefix="skuflow-renew-") + "/store"
    assert pipe.renew_forecasts(path).fitted > 0 and pipe.renew_forecasts(path).fitted == 0
    p = Pipeline.from_forecasts(spark, pipe.raw, renew.read_renewed(spark, path))
    assert p.sku_decisions().exceptAll(pipe.sku_decisions()).count() == 0 and p.sku_decisions().count() == pipe.sku_decisions().count()


def test_forecast_readers_skip_the_other_grain(pipe):
    for df in (pipe.category_accuracy(), pipe.confidence_coverage(), pipe.sku_metrics):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(grain" in plan and "(grain#" in plan


def test_decisions_join_on_one_typed_key(spark, pipe):
    from skuflow.operators import inventory
    d1 = inventory.sku_decisions(pipe.forecasts, pipe.demand_features, pipe.profitability)
    plan = d1._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.split("\n") if "Join Inner" in x]
    assert len(joins) == 2 and all("product_id" in x and "grain_key" not in x for x in joins)
    assert "order_month" not in plan and plan.count("Aggregate [") == 1                 # M1 is read, not computed again
