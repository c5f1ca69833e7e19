"""Operators for preparing training text.

Nothing outside this package imports it. Functions that run in Python workers travel with the job,
so executors need the public libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
