"""Event and changelog analytics written for Spark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers as code, so nothing is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
