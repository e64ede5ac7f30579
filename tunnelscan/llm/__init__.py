"""Operators of a training-data pipeline: tokenisation, deduplication,
decontamination, search, privacy, licences, toxicity and language-model scores.

Nothing else in the library imports this subpackage.  Its code travels with the
tasks (pickled by value), so executors need only the third-party libraries.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
