"""riskloom: transaction-risk analytics as Spark DataFrame jobs.

Subpackages
-----------
sources    table adapters, readers, sinks, presence/contract checks
functions  column expressions (pure ``Column -> Column`` helpers)
operators  DataFrame operators (joins, windows, splits, evaluation, kNN,
           resampling, models, anomaly scoring, explanation)
plans      composite jobs (feature matrix, cost report, anomaly report,
           explanation report, KPI mart)
llm        operators of a training-data pipeline (optional; nothing else imports it)
"""

__version__ = "0.1.0"

# Ship the package's UDF code inside the pickled tasks (pickle by value), so
# executors need no copy of this package on their path.
try:  # pragma: no cover - depends on the PySpark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
