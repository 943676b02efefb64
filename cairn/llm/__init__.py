"""Operators for training-data pipelines.

Nothing else in the library imports this package.  Task-side functions
travel with their tasks (pickled by value), so Python workers need numpy,
pyarrow and the named third-party libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
