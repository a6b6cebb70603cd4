"""Operators for preparing training data; nothing else in the library imports them.

Functions that run in tasks travel by value, so executors need not have the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
