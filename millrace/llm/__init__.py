"""Operators for preparing training data: one module each, queries in ``queries``.

Functions of this package that run inside tasks are sent to the executors by
value, so a cluster does not need the package on its Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
