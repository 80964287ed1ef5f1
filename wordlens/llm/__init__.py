"""Operators of a training-data pipeline: scans, deduplication, scoring, packing.

Nothing else in the library imports this subpackage. Functions that run inside Spark
tasks are pickled by value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
