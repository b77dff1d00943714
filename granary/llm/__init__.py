"""Operators of a training-data pipeline; nothing else in the library imports them.

What runs in Spark's Python workers is sent along with the tasks, so the
workers need not have this package installed.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
