"""Training-data operators: deduplication, archives, filters, redaction, packing, token output.

Functions that run in Python workers are shipped by value, so executors need the listed
third-party libraries but not this package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
