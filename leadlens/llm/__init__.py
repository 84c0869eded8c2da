"""Operators for training-data pipelines: filtering, deduplication,
decontamination, personal data and tokenisation, as Spark jobs.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions go to the executors with their code, which need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
