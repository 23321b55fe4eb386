"""Churn analytics and model operations as Spark jobs."""

import sys

from pyspark import cloudpickle

# The functions that run inside Python tasks travel with the job, so executors do not need
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
