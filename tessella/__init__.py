"""Text, set and image-similarity analytics as plain PySpark DataFrame operators.

Every operator is a function from DataFrames to a DataFrame; the caller owns the
session.  See the README for the map of the package.
"""

import sys

from pyspark import cloudpickle

# Functions shipped to Python workers (Arrow stages) travel by value, so the
# executors need pyspark, numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
