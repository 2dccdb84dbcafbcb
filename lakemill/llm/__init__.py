"""Operators for preparing large text collections for language-model training; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Python workers get these functions with their task and need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
