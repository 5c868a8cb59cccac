"""Metered-energy analytics on PySpark: clean, enrich, roll up, score, alert, forecast, report."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with the job, so executors need no copy of this
# package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
