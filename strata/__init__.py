"""strata: per-city transaction records, cleaned, filtered and nested on Spark."""

import sys as _sys

__version__ = "0.1.0"

# Functions that run in Spark's Python workers (UDFs, mapInPandas/mapInArrow
# bodies) are shipped by value, so executors need no copy of this package on
# their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: ship the package instead
    pass
