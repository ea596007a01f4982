"""docvec: files and tables to searchable vectors, written as PySpark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need only
# PySpark, pyarrow and numpy installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
