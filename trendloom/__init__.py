"""trendloom: trend analysis over large collections of short social text, on Spark.

Every operator takes a DataFrame and plain parameters and returns a lazy DataFrame.
No operator creates a session, and none changes session settings.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with the job, so the executors need no copy
# of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
