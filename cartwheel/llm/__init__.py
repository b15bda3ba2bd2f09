"""Operators for training-data pipelines over ``documents``, ``pages``,
``benchmark`` and ``labels``.

Nothing outside this folder imports it. Python functions that run in tasks are
shipped by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
