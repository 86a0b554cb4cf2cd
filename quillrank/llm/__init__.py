"""Operators of a training-data pipeline: tokens, near and exact copies, quality, packing.

Executors get this package with the plan, so they need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
