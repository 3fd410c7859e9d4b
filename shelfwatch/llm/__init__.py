"""Operators for training-data pipelines. Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the workers whole, which then need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
