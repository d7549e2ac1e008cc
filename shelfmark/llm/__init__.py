"""Training-data operators: quality, deduplication, filters, tokens and packing.

Nothing outside this package imports it. Every operator takes and returns DataFrames.
"""

import sys

from pyspark import cloudpickle

# What runs in tasks travels with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
