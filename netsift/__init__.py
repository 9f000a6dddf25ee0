"""netsift: Spark-native firewall session analytics and anomaly detection.

Modules are grouped the Spark way:

* ``sources``   — reading raw RT_FLOW syslog / CSV, fixtures derived from driver tables, sinks
* ``functions`` — column expressions (IP, port, time, safe arithmetic)
* ``operators`` — DataFrame → DataFrame operators (pairing, features, profile, metrics,
                  export, threat rules) and ``detectors`` (Spark ML style estimators)
* ``plans``     — composed plans: table catalog, registered queries, DuckDB oracle SQL
* ``streaming`` — Structured Streaming versions of parse / pairing / counts / scoring
"""

import sys as _sys

try:  # ship our own functions by value to Python workers (no PYTHONPATH needed there)
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

__version__ = "0.1.0"
