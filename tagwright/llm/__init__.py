"""Operators for preparing training text. Worker functions are shipped by value: executors need no copy."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
