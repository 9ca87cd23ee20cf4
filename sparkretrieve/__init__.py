"""Spark-native evidence retrieval: documents -> chunks -> BM25 / vectors -> fusion -> Hit@K.

Every public operator is a function from DataFrames to DataFrames. Nothing is
collected to the driver except size checks and one-row statistics.
"""

import sys as _sys

__version__ = "0.1.0"

# UDFs defined in this package are pickled by value, so Python workers run
# them even where the package is not installed (no --py-files needed).
try:  # pragma: no cover - depends on the pyspark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
