"""Archive and analyse control-system time series with Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package that run in tasks are sent whole, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
