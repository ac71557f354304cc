"""Operators for text corpora: format, deduplicate, extract, mix, pack, filter and archive."""

import sys

from pyspark import cloudpickle

# Tasks carry the code they need, so executors do not have to have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
