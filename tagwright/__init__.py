"""Spark toolkit for annotating text tables and scoring trajectories."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are sent whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
