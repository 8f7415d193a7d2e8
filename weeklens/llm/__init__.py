"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; its queries are added to the
registry by the entry module only when it can be imported. Functions that run in
Python workers are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
