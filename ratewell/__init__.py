"""Rating prediction over DataFrames: preparation, neighbourhoods, factor models, metrics."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
