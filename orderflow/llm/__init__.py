"""Operators of a training-data pipeline.  Nothing else in the library imports this subpackage.

Functions that run inside tasks are shipped by value, so executors need numpy, pyarrow and the public packages that
a function imports, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
