"""Operators for preparing training text, and the queries that run them over the test tables."""

import sys

from pyspark import cloudpickle

# Python workers get the functions of this folder with the task, wherever the driver has them from.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
