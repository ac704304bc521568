"""Train every model on one panel and compare them on its test part."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cadenza.operators.metrics import stack_models
from cadenza.operators.sets import stack
from cadenza.plans.baselines import NAIVE, compare_models, naive_forecasts
from cadenza.plans.baselines import test_part as held_out
from cadenza.plans.learners import DEPTH, TREES, choose_features, fit_boosted, fit_linear, one_target
from cadenza.plans.windowing import make_windows
from cadenza.spec import HOURLY, PanelSpec


def train_and_compare(
    panel: DataFrame,
    window: int = 24,
    trees: int = TREES,
    depth: int = DEPTH,
    top_k: int = 0,
    lags: dict[str, int] = NAIVE,
    tag: str = "",
    spec: PanelSpec = HOURLY,
) -> DataFrame:
    """Errors of the baselines, boosted trees and the second learner, best first.

    With ``top_k`` the second learner gets the pinned features and the k most
    important ones of the boosted fit. ``panel`` should be a stored table.
    """
    ws = make_windows(panel, window, spec=spec)
    raw = one_target(ws.raw)  # over the stored feature table; windows themselves are not stored
    train, test = raw.where("split = 'train'"), raw.where("split = 'test'")
    boosted = fit_boosted(train, ws.features, trees=trees, depth=depth)
    keep = choose_features(boosted, train, top_k) if top_k > 0 else None
    linear = fit_linear(train, ws.features, ws.scaler, ws.target, keep=keep)
    scored = linear.predict(boosted.predict(test, "_boosted"), "_linear")
    names = {f"Boosted{tag}": "_boosted", f"Linear{tag}": "_linear"}
    learned = stack_models(scored.withColumnRenamed("y", "y_true"), names, ["y_true"])
    naive = naive_forecasts(held_out(panel, spec), spec, lags)
    columns = ["model", "y_true", "y_pred"]
    return compare_models(stack([learned.select(*columns), naive.select(*columns)]))
