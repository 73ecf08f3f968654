"""Operators of a training-data pipeline. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so that executors need
# Spark and the libraries only, not this repository on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
