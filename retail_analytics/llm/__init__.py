"""Operators for training-data pipelines.  Their task functions travel to the executors by value, so workers need no copy of this package."""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
