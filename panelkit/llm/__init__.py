"""Operators for preparing a training corpus.

Each module holds one operator with its own general interface; ``queries``
binds them to the ``opN_<name>`` keys.  Nothing outside this package (and the
pipeline module at the repository top) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so that executors need
# numpy and the like but not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
