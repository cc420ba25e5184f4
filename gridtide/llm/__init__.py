"""Operators of a training-data pipeline.  Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package with the job, so the executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
