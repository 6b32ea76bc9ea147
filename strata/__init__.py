"""strata: a medallion production-data platform written as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in tasks travel with their code, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
