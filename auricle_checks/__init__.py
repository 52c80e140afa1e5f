"""Queries over the star-schema test tables, each with the DuckDB SQL it must agree with."""

import sys

from pyspark import cloudpickle

# The stand-in models of the checks travel with their tasks, as the library's helpers do.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
