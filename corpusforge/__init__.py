"""Token streams, shards, training windows and multiple-choice evaluation as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel with the job, so executors need no
# installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
