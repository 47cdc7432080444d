"""Operators of a training-data pipeline over documents, pages and vectors.

Nothing else in the library imports this subpackage. Its functions travel with
the query by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
