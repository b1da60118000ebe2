"""quire — text-corpus analytics on Spark.

Functions shipped to Python workers (pandas UDFs, mapInPandas, cogroups)
are pickled by value, so executors need no installed copy of this package.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__all__ = ["session"]
