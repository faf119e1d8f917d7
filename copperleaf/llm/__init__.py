"""Operators of a training-data pipeline.

Their functions travel to the executors by value, so the cluster needs no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
