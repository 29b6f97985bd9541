"""Tidemark: access-log and time-series analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Grouped-pandas helpers are shipped to executors by value, so a cluster needs
# no copy of this package on the worker's import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
