"""Training-data pipeline operators.

Each module holds one operator with its own general interface; ``queries`` holds the
thin registered queries. Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel by value, so executors need only the installed
# libraries and not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
