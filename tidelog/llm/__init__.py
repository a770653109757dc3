"""Operators of a training-data pipeline and the queries that apply them."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, package or not.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
