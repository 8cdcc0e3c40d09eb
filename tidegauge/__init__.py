"""Change-event analytics on Spark: capture, clean, window, baseline, flag, summarise, search."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to the executors by value, so it need only be installed on the driver.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
