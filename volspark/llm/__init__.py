"""Operators of a training-data pipeline (one module per operator).

Functions of this subpackage that run inside tasks are pickled by value, so
executors need the public libraries only, not an installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
