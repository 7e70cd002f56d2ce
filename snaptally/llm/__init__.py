"""Operators for training-data pipelines. Nothing outside this package imports it.

Functions that run on executors travel by value, so a worker needs only the
libraries (numpy, pyarrow), not this package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
