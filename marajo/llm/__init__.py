"""Operators for large training-data corpora. Nothing outside this package imports it.

Functions that run on executors are sent by value, so the executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
