"""Text-corpus preparation as Spark jobs: every operator takes and returns DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
