"""Orrery: Spark-native operators for vetting keyed time series, matching catalogs and curating text corpora."""

import sys

from pyspark import cloudpickle

# tasks get the functions themselves, so executors need no copy of this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
