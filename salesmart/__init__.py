"""Retail sales marts on Spark: lake, silver facts, gold marts, stock, RFM, affinity and recommendations."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need numpy and Arrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
