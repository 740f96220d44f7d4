"""Operators for large-scale training-data pipelines: tokenising, sharding, decontamination,
archives, license scans, quality rules, deduplication, near-duplicate joins, classifiers and URL
filters. Nothing else in the library imports this subpackage.

The functions that run inside tasks are pickled by value, so executors need only Spark, numpy
and pyarrow, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
