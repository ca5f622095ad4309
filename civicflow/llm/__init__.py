"""Operators of a training-data pipeline over document tables.

Nothing else in the package imports this subpackage.  Functions that run in
Python workers are pickled by value, and so are the models they use
(``stages.shared``): executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
