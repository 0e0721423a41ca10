"""Operators of a training-data pipeline, and their registered queries."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job: executors need not have this package
# installed, nor on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
