"""Training-data operators: one module per operator, ``queries.py`` for the
registered queries.  Nothing else in the library imports this subpackage.

The code that runs inside Python workers is pickled by value, so executors
need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
