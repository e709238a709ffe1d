"""Operators for training-data pipelines, and their queries over the given tables."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
