"""Score a batch of rows with a fitted forest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from gaugeflow.operators import scoring
from gaugeflow.operators.forest import Forest


def batch_score(forest: Forest, rows: DataFrame, rules: Mapping[str, object], keep: Sequence[str] = ()) -> DataFrame:
    """Rows inside the accepted ranges, completed to the forest's features, with prediction, interval and flags.

    ``keep`` names columns of ``rows`` to hand on. Rows outside the ranges are left out; see ``request_domain_filter``.
    """
    accepted, _ = scoring.request_domain_filter(rows, **rules)
    carried = {f"__kept_{c}": c for c in keep if c in forest.features}
    for name, c in carried.items():
        accepted = accepted.withColumn(name, accepted[f"`{c}`"])
    held = [c for c in keep if c not in forest.features] + list(carried)
    complete = scoring.complete_feature_vector(accepted, forest.features, keep=held)
    scored = forest.predict_interval(complete, keep=[*held, "missing_features"])
    return scoring.round_prediction(scoring.score_anomaly_flag(scored)).withColumnsRenamed(carried)
