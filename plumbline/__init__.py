"""plumbline: tabular valuation analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

# helpers used inside pandas functions travel with the job, so executors need no copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
