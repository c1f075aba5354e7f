"""Operators of a training-data pipeline; nothing else of the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value; those need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
