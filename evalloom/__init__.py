"""Spark operators for building evaluation sets, retrieving context, judging answers and monitoring request logs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to executors carry this package's code with them: it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
