"""Social-graph and news-recommendation analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run inside Python tasks travel with the task, so executors need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
