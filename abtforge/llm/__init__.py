"""Operators of a training-data pipeline: search, packing, classifiers, deduplication, filters,
mixing and scans over text corpora.  Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# code that runs in tasks travels with the task, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
