"""Operators for training-data pipelines, one module each.

Functions that run in Spark tasks are pickled by value, so executors need the
installed libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
