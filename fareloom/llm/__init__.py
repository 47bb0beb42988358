"""Operators of a training-data pipeline over `documents` and its companion tables.

The functions that run in Python workers travel by value, so a cluster needs no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
