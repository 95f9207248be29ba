"""Feedback analytics as Spark jobs: cleaning, sampling, extraction, checks and metrics."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# What runs in Python workers is sent with its code, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
