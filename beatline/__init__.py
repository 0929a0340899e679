"""beatline — periodic-connection ("beacon") analytics as Spark DataFrame jobs.

Connection records are grouped into (src_ip, dst_ip, dst_port) flows, reduced
to timing / volume / connection features with window functions and
aggregates, tagged by ordered allowlist rules, scored by a weighted formula
and a distributed isolation forest, and evaluated against ground truth.
"""

import sys as _sys

from beatline.schemas import FLOW_KEY, ML_FEATURES, RESULT_COLUMNS

# The few Python stages (capture decoding, tree growing, forest scoring) ship
# their code with the task, so executors need not have the package installed.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 — older pickler: deploy the package with --py-files
    pass

__all__ = ["FLOW_KEY", "ML_FEATURES", "RESULT_COLUMNS"]
