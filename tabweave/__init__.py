"""Tabular learning on Spark: preparation, fitting, evaluation and run history."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
