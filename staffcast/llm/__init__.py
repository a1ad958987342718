"""Operators for training data: quality, deduplication, packing, privacy, secrets, pages, search, URLs."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
