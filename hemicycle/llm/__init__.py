"""Operations of a training-data pipeline: deduplication, search, classification, encoding, mixing, rules.

Nothing else in the library imports this subpackage. Functions that run in Python workers travel with their code, so
executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
