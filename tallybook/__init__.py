"""Ledger reconciliation on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors inside the job, so that a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
