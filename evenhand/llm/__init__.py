"""Operators of a training-data pipeline on tables of documents and conversations.

Code that runs in Python workers is shipped by value, so executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
