"""Training-data operators. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
