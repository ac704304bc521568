"""The driver contract, and a sample of queries against their SQL on the given tables."""

import importlib.util
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMALL = "/root/testdata/sf0.001"
sys.path.insert(0, os.path.join(ROOT, "tools"))

CHECKED = [
    "hourly_sum", "hourly_sum_strict", "densify_hourly", "densify_daily", "weather_clean", "panel_borrowed_weather",
    "time_features", "rolling_folds", "backtest_origins", "window_targets", "target_roundtrip", "model_comparison",
    "histogram_50", "quality_summary", "forecast_naive", "xml_rows", "pending_work", "tm_to_lonlat", "date_functions",
    "value_functions", "lag_gappy", "ingest_resume", "ingest_progress", "corr_matrix", "windows_long", "scaled_panel",
    "lag_features", "spot_ids", "history_with_spots", "feature_scaler",
]


@pytest.fixture(scope="module")
def contract():
    spec = importlib.util.spec_from_file_location("contract", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_entry(spark, contract):
    rows = contract.entry(spark).collect()
    assert rows and rows[0].n >= 10


def test_names(contract):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(CHECKED) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, contract, name):
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    from compare import database, differences

    got = contract.queries()[name](spark, SMALL).toPandas()
    want = database(SMALL).execute(contract.oracle_sql()[name]).fetchdf()
    assert differences(got, want) == ""


def test_ordered_work_is_never_on_one_partition(spark, contract):
    for name in ("windows_long", "densify_hourly", "label_at_horizon"):
        plan = contract.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        assert windows and all("_segment" in line for line in windows), name
