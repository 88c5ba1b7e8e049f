"""Labelled images and vectors to features, reduced tables, classifiers and reports, on Spark.

Every public function takes and returns DataFrames (or a small fitted model). The few helper
functions that run in Python workers are sent by value, so the package need not be installed
on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
