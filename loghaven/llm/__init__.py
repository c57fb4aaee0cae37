"""Operators of a training-data pipeline over tables of documents and vectors.

Functions that run in tasks are sent to the executors with their code, so a cluster needs
no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
