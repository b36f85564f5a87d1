"""Location-based trip analytics and run metrics as Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Python helpers travel inside the tasks that use them, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
