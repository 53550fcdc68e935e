"""Sensor and event time-series analytics expressed as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

from tidewatch.plans.series import Profile, Series, load_series, numeric_columns

__all__ = ["Profile", "Series", "load_series", "numeric_columns"]

# The few functions that run in Python workers travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
