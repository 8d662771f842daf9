"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Helper functions that
run inside tasks are pickled by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
