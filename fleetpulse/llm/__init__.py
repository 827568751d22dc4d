"""Operators for building language-model training sets, and their registered queries.

Each module holds one operator with its general interface; ``queries`` derives the
registered result of each from it. Nothing outside this folder imports it.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
