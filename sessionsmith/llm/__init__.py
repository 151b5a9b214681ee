"""Operators for preparing large text corpora.

The functions that run inside tasks are sent by value, so executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
