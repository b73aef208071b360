"""Operators for training corpora: quality, duplicates, leaks, secrets, licences, pieces, chat."""

import sys

from pyspark import cloudpickle

# functions travel to the tasks with the plan: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
