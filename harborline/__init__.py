"""harborline: a Spark-native engine for supply-chain event data."""

import sys

from pyspark import cloudpickle

# functions go to the Python workers by value, so that executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
