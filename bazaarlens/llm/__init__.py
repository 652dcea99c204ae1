"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers whole, so that executors need no
# installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
