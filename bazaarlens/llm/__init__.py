"""Operators for preparing training text; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions sent to Python workers carry their code, so that workers need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
