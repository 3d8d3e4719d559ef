"""Operators for large training-data pipelines; nothing else in the package imports this."""

import sys

from pyspark import cloudpickle

# Python workers get the functions themselves: no install on the executors is needed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
