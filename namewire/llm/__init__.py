"""Operators of a training-data pipeline: cleaning, deduplication, scoring, mixing, packing.

Nothing else in the library imports this subpackage. Functions that run inside
tasks travel with the job, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
