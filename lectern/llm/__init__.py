"""Training-data operators: quality, licences, personal data, contamination, archives, duplicates, text, tokens."""

import sys

from pyspark import cloudpickle

# What the tasks run travels with them, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
