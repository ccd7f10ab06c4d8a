"""Operators for training-data pipelines: filters, deduplication, scoring, mixing, encoding.

The functions that run in Python workers are shipped by value, so that an
executor needs numpy, pyarrow and the like, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
