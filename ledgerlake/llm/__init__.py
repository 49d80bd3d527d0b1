"""Operators for preparing training data. Nothing else in the library imports this package.

Functions that run inside Spark's Python workers are shipped by value, so that executors
need this package's libraries but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
