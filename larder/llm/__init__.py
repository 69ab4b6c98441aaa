"""Operators for preparing training text: scoring, deduplication, mixing, packing.

Nothing else in the library imports this package. Functions that run on executors are sent there
whole, so executors need the libraries of the image but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
