"""Operators for preparing language-model training data, one module each.

Nothing else in the library imports this package; ``queries`` holds the
registered queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# Task functions travel whole, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
