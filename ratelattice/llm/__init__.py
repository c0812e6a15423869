"""Operators for preparing text corpora; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# the functions travel to the workers by value, so those need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
