"""Operators for preparing training data, and the queries that apply them.

Code of this subpackage travels to the executors with the tasks, so a cluster
needs no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
