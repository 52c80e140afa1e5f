"""Auricle: media content-review data jobs on Spark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle

# Python helpers that run inside tasks travel with the task, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
