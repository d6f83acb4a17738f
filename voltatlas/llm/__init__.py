"""Training-data operators: scoring, search, duplicate removal, mixing, sharding and packing."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code with them, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
