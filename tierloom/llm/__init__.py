"""Operators for training-data corpora: dedup, quality, tokens, archives, mixing, models.

Functions that run in Python workers travel by value, so executors need no
copy of this package, only its libraries (numpy, pyarrow, duckdb, ...).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
