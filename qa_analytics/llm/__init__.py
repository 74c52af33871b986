"""Operators for preparing training text; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions travel to the workers by value, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
