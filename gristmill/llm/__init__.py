"""Operators for training-data pipelines; nothing outside this folder imports them.

Functions of this package travel to the tasks by value, so executors need the
installed libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
