"""Operators for training-data pipelines (scoring, filtering, deduplication, mixing, output).

Functions that run in Python workers are pickled by value, so a job needs neither this package on
the executors nor a ``--py-files`` archive.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
