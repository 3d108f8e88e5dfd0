"""Operators for large training corpora: one module per operator, their queries in ``queries``."""

import sys

from pyspark import cloudpickle

# task functions travel with their code, so that executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
