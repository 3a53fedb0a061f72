"""Operators for preparing training data from large text, page and vector tables.

Python functions of this package are sent to the executors by value, so executors need
no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
