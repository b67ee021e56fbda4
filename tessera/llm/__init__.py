"""Training-data operators (one module each) and their registered queries.

Nothing else in the library imports this subpackage.  Functions that run in
Spark's Python workers are pickled by value, so the workers need no copy of
the library on their own import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
