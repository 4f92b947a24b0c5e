"""Operators for preparing training data: ten operators and the pipeline built of them.

Functions that run on executors are sent by value, so that an executor needs only Spark and
the named third-party packages, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
