"""Document-to-graph analytics on Spark DataFrames.

The package is pickled by value into Python workers, so executors need neither this repository
on their path nor an installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
