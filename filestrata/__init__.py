"""Spark-native engine that turns folders of messy business files into tables."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
