"""Scholarship matching on Spark: operators that take and return DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their task, so executors need
# no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
