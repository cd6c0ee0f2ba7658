"""Operators for preparing training data; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Functions go to the workers by value, so that executors do not need this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
