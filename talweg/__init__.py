"""Spark-native geospatial logistics analytics."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with the plan: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
