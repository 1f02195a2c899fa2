"""Operators of a training-data pipeline over text tables.

Functions that run inside tasks travel with the job (pickled by value), so executors
need no copy of this package on their own disks.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
