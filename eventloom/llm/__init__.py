"""Operators for text corpora: cleaning, de-duplication, scoring and mixing of documents."""

import sys

from pyspark import cloudpickle

# Send these functions by value, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
