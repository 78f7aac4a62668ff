"""Motion and wearable-sensor data jobs on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
