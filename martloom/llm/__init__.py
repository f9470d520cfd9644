"""Operators for preparing training data: extraction, filtering, deduplication, encoding, sharding."""

import sys

from pyspark import cloudpickle

# functions of this package travel to executors with the job, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
