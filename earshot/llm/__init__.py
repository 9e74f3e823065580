"""Operators for preparing training text at corpus scale.

Nothing outside this folder imports it. Functions that run inside tasks are sent to the
executors by value, so a cluster needs no copy of this package on its workers' path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
