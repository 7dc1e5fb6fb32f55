"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Python workers get the functions of this package with the tasks; nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
