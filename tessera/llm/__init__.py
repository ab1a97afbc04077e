"""Operators for training-data pipelines over the ``documents`` table; ``catalog`` registers their queries.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Tasks get this package's code with the job, so workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
