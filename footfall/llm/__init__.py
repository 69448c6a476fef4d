"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``conversations``.

Nothing outside this package imports it.  Functions that run in Python workers are shipped by value, so
executors need numpy, pyarrow, pandas and xxhash, but no copy of this package.

Common to all operators: the columns they read are parameters; a column of the input that has the name
of a result column (in any case) is replaced by the result; other columns are carried along or not, as
each docstring says.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
