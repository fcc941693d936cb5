"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to the executors whole, which then need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
