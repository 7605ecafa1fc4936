"""Explore, clean and map large collections of text and vectors on Spark."""

import sys

from pyspark import cloudpickle

# Task functions travel to the executors by value, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
