"""Operators for preparing language-model training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the executors with their code, so the library need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
