"""Operators of a training-data pipeline over documents, pages and benchmarks.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` applies them to the tables.

The functions that run inside tasks are shipped by value, so executors need
the third-party libraries but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
