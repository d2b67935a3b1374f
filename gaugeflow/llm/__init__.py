"""Operators for large training-data pipelines."""

import sys

from pyspark import cloudpickle

# Tasks carry the code of this subpackage, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
