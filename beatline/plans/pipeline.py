"""V2/V3: the detection pipeline as one composed DataFrame plan.

features (one exchange of the records) → allowlist → composite score →
[isolation forest: fit on the benign-looking flows, score, explain] →
verdict → 14-column result, best first.  Without the model the whole plan
is lazy; with it, the scored flow table is checkpointed to the shared
checkpoint folder first, since the fit and the scoring read it several times.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.operators.allowlist import apply_allowlist
from beatline.operators.features import DEFAULT_HOT_FLOW_ROWS, engineer_features
from beatline.operators.scoring import score_flows
from beatline.operators.verdict import (
    assign_verdicts, benign_for_training, result_table, verdict_counts, verdict_slice,
)
from beatline.schemas import MIN_CONNECTIONS
from beatline.session import checkpoint_dir

MIN_TRAINING_ROWS = 5
log = logging.getLogger(__name__)


def scored_flows(connections: DataFrame, min_connections: int = MIN_CONNECTIONS,
                 hot_flow_rows: int | None = DEFAULT_HOT_FLOW_ROWS) -> DataFrame:
    """Features → allowlist → composite score (lazy)."""
    feats = engineer_features(connections, min_connections, hot_flow_rows=hot_flow_rows)
    return score_flows(apply_allowlist(feats))


def _without_model(scored: DataFrame) -> DataFrame:
    return scored.withColumns({"ml_score": F.lit(0.0), "ml_explanation": F.lit("")})


def run_pipeline(connections: DataFrame, min_connections: int = MIN_CONNECTIONS,
                 use_model: bool = True, baseline: DataFrame | None = None,
                 n_trees: int = 200, seed: int = 42, explain_threshold: float = 70.0,
                 hot_flow_rows: int | None = DEFAULT_HOT_FLOW_ROWS,
                 sort: bool = True) -> DataFrame:
    """Connection records in, the 14-column result table out.

    ``baseline``: optional extra benign feature rows (S7/S8) for training.
    If fewer than five benign flows exist (or ``use_model`` is off) the model
    columns are 0 / ''.
    """
    scored = scored_flows(connections, min_connections, hot_flow_rows)
    if use_model:
        from beatline.operators import anomaly
        checkpoint_dir(scored.sparkSession)
        scored = scored.checkpoint(eager=True)
        benign = scored.where(benign_for_training())
        try:
            model = anomaly.fit(benign, baseline=baseline, n_trees=n_trees, seed=seed,
                                min_benign_rows=MIN_TRAINING_ROWS)
        except ValueError as e:     # no usable training rows; failures of jobs rise
            log.warning("model left out: %s", e)
            model = None
        if model is not None:
            scored = anomaly.explain_all(anomaly.score(model, scored), model.stats,
                                         threshold=explain_threshold)
        else:
            scored = _without_model(scored)
    else:
        scored = _without_model(scored)
    return result_table(assign_verdicts(scored), sort=sort)


def summary(results: DataFrame, top_high: int = 10, top_medium: int = 5,
            top_explained: int = 5) -> dict[str, DataFrame]:
    """V3: the tables behind the printed summary (printing is the caller's)."""
    from beatline.operators.explore import top_k
    return {
        "verdict_counts": verdict_counts(results),
        "top_high": top_k(verdict_slice(results, "HIGH"), top_high),
        "top_medium": top_k(verdict_slice(results, "MEDIUM"), top_medium),
        "explained": top_k(verdict_slice(results, "EXPLAINED"), top_explained),
    }
