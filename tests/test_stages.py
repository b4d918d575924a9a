"""Stored stages can all be freed: a run leaves no folder behind."""
from pathlib import Path

from skuflow import session
from skuflow.plans.pipeline import Pipeline

from conftest import SF_SMALL


def _folders(spark):
    root = Path(session.ensure_checkpoint_dir(spark).removeprefix("file:"))
    return {p for kind in ("skuflow-stages", "skuflow-tables") if (root / kind).exists() for p in (root / kind).rglob("*.parquet")}


def test_a_run_leaves_no_stage_behind(spark, monkeypatch):
    monkeypatch.setattr(session, "_STAGES", [])
    before = _folders(spark)
    pipe = Pipeline.from_testdata(spark, SF_SMALL, forecaster="moving_average", stored_tables=True)
    for view in (pipe.action_list, pipe.profit_pareto, pipe.confidence_scorecard, pipe.key_report, pipe.load_report):
        assert view().count() > 0
    assert _folders(spark) > before
    pipe.release()
    session.release_stages(spark)
    assert _folders(spark) == before and not session._STAGES


def test_pipelines_do_not_free_each_others_stages(spark):
    one, two = (Pipeline.from_testdata(spark, SF_SMALL, forecaster="moving_average") for _ in range(2))
    n = two.sku_revenue.count()
    assert one.sku_revenue.count() == n
    one.release()
    assert two.sku_revenue.count() == n
    two.release()
