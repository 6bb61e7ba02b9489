"""Operators of a training-data pipeline.  Nothing else in the library imports this subpackage.

The functions that run inside tasks travel to the executors by value, so executors need this package
neither installed nor on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
