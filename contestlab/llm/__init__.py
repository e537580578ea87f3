"""Operators for preparing language-model training data.

Functions that run on executors are sent there with their code, so executors
need the usual libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
