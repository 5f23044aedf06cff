"""Operators for training-data pipelines."""

import sys

from pyspark import cloudpickle

# What runs in Spark's Python workers travels with the task, so that they need not be able to import it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
