"""Operators for training-data corpora: duplicates, privacy, quality, mixing, tokens.

Nothing else in the library imports this package. Work on text runs in numpy over Arrow
batches inside Spark tasks, or in plain DataFrame functions.
"""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
