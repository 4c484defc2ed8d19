"""Training-data operators: each module holds one operator, ``queries`` registers them.

Nothing outside this package imports it. Functions that run inside tasks are
shipped by value, so executors need only Spark's own Python dependencies.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
