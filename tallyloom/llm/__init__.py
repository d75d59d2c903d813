"""Operators for large training corpora. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Executors get these functions with the task, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
