"""Roentra: Spark jobs that take imaging metadata from raw to training-ready."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Task functions travel inside the job, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
