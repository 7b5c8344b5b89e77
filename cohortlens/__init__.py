"""Replicated single-cell study analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# small Python helpers travel with the job, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
