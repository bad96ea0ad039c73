"""shelfspark: retail price and store-location analytics on Spark.

Functions that run inside Python workers (``mapInPandas`` closures and the
helpers they call) are pickled *by value*, so executors need no installed
copy of this package and no particular working directory.
"""

try:
    from pyspark import cloudpickle as _cloudpickle
    import sys as _sys

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: fall back to by-reference
    pass
