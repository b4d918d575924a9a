"""Gap filling, the moving-average forecaster and Holt-Winters."""
import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from skuflow.operators import demand, forecast
from skuflow.params import ForecastParams


def _series(spark, values, key="k", start=dt.date(2020, 1, 1)):
    rows = []
    for i, v in enumerate(values):
        if v is None:
            continue
        m = dt.date(start.year + (start.month - 1 + i) // 12, (start.month - 1 + i) % 12 + 1, 1)
        rows.append(("sku", key, "c", m, v))
    return spark.createDataFrame(rows, "grain string, grain_key string, category string, month date, units long")


def test_gap_fill_keeps_totals_and_fills_zeros(spark):
    s = _series(spark, [3, None, None, 5, 1])
    f = demand.gap_fill(s).orderBy("t").collect()
    assert [r["units"] for r in f] == [3, 0, 0, 5, 1]
    assert [r["t"] for r in f] == [0, 1, 2, 3, 4] and all(r["n"] == 5 for r in f)


def test_moving_average_forecast(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 0]
    f = demand.moving_average_forecast(demand.gap_fill(_series(spark, vals))).orderBy("forecast_month").collect()
    assert len(f) == 3
    assert float(f[0]["predicted_units"]) == 5.0                 # mean(7, 8, 0)
    # backtest: forecast mean(4, 5, 6) = 5 against 7, 8, 0 -> MAE 10/3, MAPE over non-zero actuals
    assert float(f[0]["mae"]) == 3.33
    assert float(f[0]["mape_pct"]) == round((2 / 7 + 3 / 8) / 2 * 100, 1)
    assert f[0]["forecast_month"] == dt.date(2020, 10, 1)
    assert f[0]["confidence"] == "medium"


def test_short_series_get_no_forecast(spark):
    f = demand.gap_fill(_series(spark, [1, 2, 3, 4, 5]))
    assert demand.moving_average_forecast(f).count() == 0
    assert forecast.holt_winters(f).count() == 0


def test_holt_winters_recovers_noiseless_series():
    t = np.arange(40.0)
    lin = 5 + 2 * t
    sea = 10 + 0.5 * t + 3 * np.sin(2 * np.pi * t / 12)
    (f_lin, _), = forecast._fit(lin[None, :], [np.array([37])], 12, False, 3)
    assert np.allclose(f_lin[0], lin[37:40], atol=1e-4)
    (f_sea, sd), = forecast._fit(sea[None, :], [np.array([37])], 12, True, 3)
    assert np.allclose(f_sea[0], sea[37:40], atol=1e-4) and sd[0] < 1e-6


def test_holt_winters_job_shapes(spark):
    rng = np.random.default_rng(1)
    short = [int(x) for x in rng.poisson(4, 12)]     # trend-only path
    long_ = [int(x) for x in rng.poisson(6, 30)]     # seasonal path
    s = _series(spark, short, "a").unionByName(_series(spark, long_, "b"))
    out = forecast.holt_winters(demand.gap_fill(s), ForecastParams()).collect()
    models = {r["grain_key"]: r["model_used"] for r in out}
    assert models == {"a": "HW-trend", "b": "HW-seasonal"}
    assert len(out) == 6
    assert all(float(r["lower_bound"]) <= float(r["predicted_units"]) <= float(r["upper_bound"]) for r in out)
    assert all(float(r["predicted_units"]) >= 0 for r in out)


def test_stored_accuracy_equals_the_holdout_segments(spark):
    """MAE and MAPE of the table, recomputed from the chart rows of the same fit."""
    rng = np.random.default_rng(2)
    p = ForecastParams()
    s = _series(spark, [int(x) for x in rng.poisson(3, 20)], "a").unionByName(_series(spark, [int(x) for x in rng.poisson(5, 40)], "b"))
    filled = demand.gap_fill(s)
    fits = forecast.fit_series(filled, p)
    rows = forecast.segment_rows(filled, fits, p).collect()
    table = {r["grain_key"]: r for r in forecast.forecast_rows(fits).collect()}
    for key, n in (("a", 20), ("b", 40)):
        part = {seg: [float(r["value"]) for r in sorted(rows, key=lambda r: r["month"]) if r["grain_key"] == key and r["segment"] == seg]
                for seg in ("train", "holdout_actual", "holdout_forecast", "forecast")}
        assert [len(v) for v in part.values()] == [n - 3, 3, 3, 3]
        miss = [abs(x - y) for x, y in zip(part["holdout_actual"], part["holdout_forecast"])]
        assert abs(float(table[key]["mae"]) - sum(miss) / 3) < 0.02
        shares = [m / x for m, x in zip(miss, part["holdout_actual"]) if x]
        assert abs(float(table[key]["mape_pct"]) - 100 * sum(shares) / len(shares)) < 0.5


def test_search_is_never_worse_than_a_dense_grid_of_weights():
    """The walk may stop anywhere, but not above what the whole admissible range offers on a dense grid."""
    rng = np.random.default_rng(3)
    level = np.cumsum(rng.normal(0, 1, (6, 45)), axis=1) + 20
    beta_heavy = np.cumsum(np.cumsum(rng.normal(0, 0.5, (6, 45)), axis=1), axis=1) + 30
    Y = np.concatenate([level, beta_heavy])
    cut = np.full(len(Y), 45)
    (_, sd), = forecast._fit(Y, [cut], 12, False, 3)
    dense = np.array([(a, b * a, 0.0) for a in np.linspace(0.02, 0.98, 33) for b in np.linspace(0, 1, 21)])
    _, _, sse, _ = forecast._fit_local(Y, cut, np.broadcast_to(dense, (len(Y), *dense.shape)).copy(), 12, False, 3)
    _, best_sd, _, _ = forecast._fit_local(Y, cut, np.broadcast_to(dense, (len(Y), *dense.shape)).copy(), 12, False, 3)
    assert (sd <= best_sd * 1.01).all() and np.isfinite(sse).all()


def test_series_run_up_to_a_month(spark):
    rows = [(1, "c", f"2020-{m:02d}", 5) for m in range(1, 8)] + [(2, "c", f"2020-{m:02d}", 4) for m in range(1, 11) if m != 5]
    monthly = spark.createDataFrame(rows, "product_id long, category string, order_month string, units_sold long")

    def lengths(p):
        out = {r["grain_key"]: (r["n"], r["u"], r["k"]) for r in demand.sku_filled(monthly, p).groupBy("grain_key").agg(
            F.max("n").alias("n"), F.sum("units").alias("u"), F.count(F.lit(1)).alias("k")).collect()}
        assert all(n == k for n, _, k in out.values())
        return {key: (n, u) for key, (n, u, _) in out.items()}
    assert lengths(ForecastParams()) == {"1": (7, 35), "2": (10, 36)}
    assert lengths(ForecastParams(as_of="last")) == {"1": (10, 35), "2": (10, 36)}
    assert lengths(ForecastParams(as_of="2020-12")) == {"1": (12, 35), "2": (12, 36)}
    assert lengths(ForecastParams(as_of="2020-08")) == {"1": (8, 35), "2": (10, 36)}      # later sales stay
    filled = demand.sku_filled(monthly, ForecastParams(as_of="last")).where("grain_key = '1'").orderBy("t").collect()
    assert [r["units"] for r in filled] == [5] * 7 + [0] * 3 and filled[-1]["month"] == dt.date(2020, 10, 1)
    months = demand.category_filled(monthly, ForecastParams(as_of="2021-01")).collect()
    assert len(months) == 13 and sum(r["units"] for r in months) == 71


def test_bias_against_forecast_skus_only(spark):
    from skuflow.operators.forecast_reports import category_bias
    monthly = spark.createDataFrame([(1, "c", "2020-05", 10), (2, "c", "2020-05", 30), (1, "c", "2020-01", 99)],
                                    "product_id long, category string, order_month string, units_sold long")
    forecasts = spark.createDataFrame([("sku", "1", "c", 12.0), ("category", "c", "c", 50.0)], "grain string, grain_key string, category string, predicted_units double")
    assert category_bias(monthly, forecasts).first()["recent_actual"] == 40
    only = category_bias(monthly, forecasts, forecast_skus_only=True).first()
    assert only["recent_actual"] == 10 and float(only["bias_pct"]) == 20.0 and only["bias_flag"] == "over"


def _direct_sse(y, w, m, seasonal):
    """Least SSE over start values, from plain recursions of each unit start value."""
    x = forecast._basis(m, seasonal)
    a, b, g = w

    def run(state, data):
        lvl, trd, ring, out = state[0], state[1], list(state[2:]), []
        for t, v in enumerate(data):
            pred = lvl + trd + (ring[t % m] if seasonal else 0.0)
            out.append(pred)
            e = v - pred
            if seasonal:
                ring[t % m] += g * e
            new = lvl + trd + a * e
            trd = (1 - b) * trd + b * (new - lvl)
            lvl = new
        return np.array(out)
    R = np.stack([run(x[:, j], np.zeros(len(y))) for j in range(x.shape[1])], axis=1)
    e = y - run(np.zeros(len(x)), y)
    return float(((e - R @ np.linalg.lstsq(R, e, rcond=None)[0]) ** 2).sum())


def test_walk_uses_each_weights_own_least_squares():
    rng = np.random.default_rng(2)
    for seasonal in (False, True):
        n = np.array([30, 41, 41, 36])
        Y = np.zeros((4, 41))
        for i, c in enumerate(n):
            Y[i, :c] = rng.poisson(8 + 4 * np.sin(np.arange(c) / 12 * 2 * np.pi))
        W = np.round(rng.uniform(0.05, 0.45, (4, 5, 3)), 3) * (1.0, 0.5, 1.0 if seasonal else 0.0)
        W[2] = W[1]                                             # shared weights
        _, sd, sse, best = forecast._fit_local(Y, n, W, 12, seasonal, 3)
        for i, c in enumerate(n):
            direct = [_direct_sse(Y[i, :c], w, 12, seasonal) for w in W[i]]
            assert np.isclose(sse[i], min(direct), rtol=1e-6) and np.isclose(direct[best[i]], min(direct), rtol=1e-9)
            assert sd[i] ** 2 * c <= sse[i] + 1e-9
    # the grid's fit of several lengths in one call equals one call each
    cuts = np.array([30, 41, 41, 36])
    (f, s), = forecast._fit(Y, [cuts], 12, True, 3)
    for i, c in enumerate(cuts):
        (f1, s1), = forecast._fit(Y[i:i + 1, :c], [cuts[i:i + 1]], 12, True, 3)
        assert np.allclose(f[i], f1[0]) and np.isclose(s[i], s1[0])


def test_one_factor_gives_the_least_error_of_every_length():
    rng = np.random.default_rng(4)
    for seasonal, ends in ((True, [24, 31, 40]), (False, [6, 17, 40])):
        Y = rng.poisson(6, (3, 40)).astype(float)
        cut = np.array(ends)
        Z = forecast._differences(Y, 12, seasonal)
        (best, low), = forecast._grid_search(Z, [cut - (40 - Z.shape[1])], 12, seasonal)
        grid = forecast.weight_grid(seasonal)
        for i, c in enumerate(ends):
            direct = [_direct_sse(Y[i, :c], w, 12, seasonal) for w in grid]
            assert np.isclose(low[i], min(direct), rtol=1e-6) and np.isclose(direct[best[i]], min(direct), rtol=1e-9)


def test_walk_shares_factors_between_series(monkeypatch):
    """All series under the same weights: one factor for all of them, whatever their lengths."""
    made, bands = [], forecast._bands
    monkeypatch.setattr(forecast, "_bands", lambda w, *a: made.append(len(w)) or bands(w, *a))
    rng = np.random.default_rng(5)
    n = rng.integers(27, 41, 200)
    Y = np.where(np.arange(40) < n[:, None], rng.poisson(5, (200, 40)), 0).astype(float)
    W = np.tile([[0.3, 0.1, 0.2], [0.25, 0.1, 0.2]], (200, 1, 1))
    forecast._fit_local(Y, n, W, 12, True, 3)
    assert sum(made) == 2


def test_series_are_sent_to_python_as_one_row_each(spark):
    rng = np.random.default_rng(6)
    p = ForecastParams()
    s = _series(spark, [int(x) for x in rng.poisson(3, 20)], "a").unionByName(_series(spark, [int(x) for x in rng.poisson(5, 40)], "b"))
    filled = demand.gap_fill(s)
    fits = forecast.fit_series(filled, p)
    plan = fits._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan
    # rows in any order, in calls of one series each, beside a series without a key
    no_key = filled.where("grain_key = 'a'").withColumn("grain_key", F.lit(None).cast("string"))
    again = forecast.fit_series(filled.unionByName(no_key).orderBy(F.desc("t")), p, 1)
    key = lambda r: (r["grain_key"], r["segment"], r["month"])
    one, two = sorted(fits.collect(), key=key), sorted(again.collect(), key=key)
    assert one == two and len(one) == 12


def test_a_missing_value_spoils_only_what_it_is_fitted_on():
    rng = np.random.default_rng(7)
    Y = rng.poisson(5, (3, 40)).astype(float)
    whole = forecast._fit_series(Y, np.full(3, 40), ForecastParams())
    Y[1, 38] = np.nan
    bt, full, sd, _ = forecast._fit_series(Y, np.full(3, 40), ForecastParams())
    assert np.allclose(bt, whole[0]) and np.allclose(full[[0, 2]], whole[1][[0, 2]])
    assert np.isnan(full[1]).all() and np.isnan(sd[1])


def test_filled_series_take_one_window_and_no_sort_by_grain(spark):
    from skuflow.plans.pipeline import Pipeline
    rows = [(k, f"c{k % 2}", f"2020-{m:02d}", 4 + k) for k in range(5) for m in range(1, 13) if (m + k) % 4]
    monthly = spark.createDataFrame(rows, "product_id long, category string, order_month string, units_sold long")
    plan = demand.sku_filled(monthly)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Window [") == 1
    stored = Pipeline.from_demand_series(spark, monthly).filled_series
    lazy = Pipeline.from_demand_series(spark, monthly, store="none").filled_series
    assert stored.columns == lazy.columns and stored.schema["grain"].dataType == lazy.schema["grain"].dataType
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, lazy.collect()))
    assert {f.split("grain=")[1].split("/")[0] for f in stored.inputFiles()} == {"sku", "category"}
    got = sorted((r["grain_key"], r["t"], r["units"], r["n"]) for r in stored.where("grain = 'sku' and grain_key = '1'").collect())
    assert got == [("1", t, 0 if (t + 2) % 4 == 0 else 5, 12) for t in range(12)]
