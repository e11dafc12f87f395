"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it.  Functions that run on executors are pickled by
value, so that a cluster needs no copy of the package on its Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
