"""Operators for large-scale training-data pipelines; nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so that workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
