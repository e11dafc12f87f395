"""Document knowledge bases on Spark."""

import sys

from pyspark import cloudpickle

# executors need no copy of the package: what runs there is pickled by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])
