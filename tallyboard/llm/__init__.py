"""Operators for preparing training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Code that runs in tasks travels with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
