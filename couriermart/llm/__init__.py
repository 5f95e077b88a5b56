"""Operators for training-data pipelines. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
