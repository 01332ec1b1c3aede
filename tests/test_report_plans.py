"""How often the report queries read the fact table and make their predictions."""

import os

import pytest

from shelfspark.operators import baselines
from shelfspark.plans import catalog
from shelfspark.sources import star_tables

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.load()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture
def calls(monkeypatch):
    seen = []
    for module, name in ((star_tables, "raw_sales"), (baselines, "add_baselines")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *how, name=name, real=real: (seen.append(name), real(*how))[1])
    return seen


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", ["performance_report", "performance_report_file"])
def test_a_report_reads_the_facts_once(spark, calls, name):
    assert QUERIES[name].build(spark, FOLDER).count() == 6
    assert calls == ["raw_sales", "add_baselines"]


@pytest.mark.parametrize("name", ["performance_report", "best_model_per_level", "registration_plan", "metric_comparison"])
def test_model_metrics_do_not_predict_again(spark, capsys, name):
    assert "rolling_7" not in plan_of(QUERIES[name].build(spark, FOLDER), capsys)


@pytest.mark.parametrize("name", ["residual_summary", "error_histogram", "residual_histogram"])
def test_residuals_are_stored_before_they_are_read_again(spark, capsys, calls, name):
    plan = plan_of(QUERIES[name].build(spark, FOLDER), capsys)
    assert "rolling_7" not in plan and "Window [lag" not in plan
    assert calls == ["raw_sales", "add_baselines"]
