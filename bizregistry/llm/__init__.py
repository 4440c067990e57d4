"""Training-data operators. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the plan, so executors need numpy, pyarrow
# and the tokenizer libraries, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
