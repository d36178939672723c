"""Operators of a training-data pipeline.  Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors as code, so that it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
