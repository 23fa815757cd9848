"""Wattspan: electricity price forecasting and storage dispatch analytics on Spark."""

import sys

from pyspark import cloudpickle

# Executors may not have this package installed; ship its functions inside the closures.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
