"""tidemark: event-time analytics on Spark DataFrames and streams."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Task functions that run in Python workers (mapInPandas folds, stateful
# processors, user window functions) refer to code in this package.  Pickling
# the package by value ships that code with the task, so executors need no
# installed copy and the caller's working directory does not matter.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
