"""Spark-native ingest, validation, loading, profiling and analytics for commerce data."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with their code, so that a cluster needs no
# copy of the package on its executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])
