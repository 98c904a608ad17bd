"""reviewloom: batch operators for customer reviews, products and questions on Spark.

Functions take and return DataFrames. Only ``operators.gates``, ``plans`` and the size
check of ``operators.search`` run jobs of their own.
"""

import sys

from pyspark import cloudpickle

# What runs in Python workers travels with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
