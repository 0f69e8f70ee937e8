"""Training-data operators over document tables.

Every operator takes DataFrames and column names and returns a DataFrame;
``queries`` holds the thin catalogue entries over the driver's tables.
Nothing else in the library imports this subpackage.

Functions that run in Python workers are shipped by value, so the package
need not be installed on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
