"""gridcast: gridded sensor telemetry on Spark (tables and streams)."""

import sys

from pyspark import cloudpickle

# Python workers may not have this package on their path (it is not
# installed, only imported by the driver).  Pickling its functions by value
# ships the code of the pandas UDFs with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
