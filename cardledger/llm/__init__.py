"""Operators for training-data pipelines: cleaning, matching, scoring, mixing and packing of documents.

Nothing outside this package imports it.  Functions that run in Python tasks
travel with the tasks, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
