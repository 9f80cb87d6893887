"""Operators of a large-scale training-data pipeline.

Each module holds one operator: the general interface (any DataFrame, column
names as parameters) and the registered ``opN_*`` query over the given
tables.  Nothing outside this folder imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the tasks by value, so workers need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
