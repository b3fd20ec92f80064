"""Operators that prepare text for training: scoring, mixing, deduplication, packing.

Functions of this subpackage that run inside tasks travel by value, so
executors need Python packages but not this library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
