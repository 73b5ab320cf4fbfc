"""Operators of a training-data pipeline, their queries and their SQL.

Nothing outside this folder imports it. The functions that run inside tasks
travel by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
