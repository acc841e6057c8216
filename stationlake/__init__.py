"""stationlake: DataFrame operators and jobs for station-based daily observations.

Everything here is composed from public Spark DataFrame/SQL functions; the
only Python that runs on executors is the archive reader in
``sources.archives`` (``mapInPandas``).
"""

__version__ = "0.1.0"

# Functions that run on executors (mapInPandas) are shipped by value, so the
# workers need no installed copy of this package.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
