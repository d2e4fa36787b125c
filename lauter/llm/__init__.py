"""Operators of a training-data pipeline; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the workers with their code, so that a cluster
# needs no copy of the package on its executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])
