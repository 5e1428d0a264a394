"""Training-data operators: deduplication, extraction, scoring, archives, filters, mixing, decontamination,
conversation tries, vector search and whitening.

Functions of this package travel to the executors by value, so these need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
