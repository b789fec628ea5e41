"""Text retrieval and its evaluation as Spark jobs over tables."""

import sys

from pyspark import cloudpickle

# Functions run by Python workers are shipped with the job, so executors need
# no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
