"""jobsluice: a Spark engine for collected job listings.

Every operator is a function from DataFrames to a DataFrame (or a Column
builder); nothing reads the clock, every run date and policy is an argument.
"""

import sys

from pyspark import cloudpickle

# Ship the helper functions of the Python stages with the tasks, so that executors
# need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
