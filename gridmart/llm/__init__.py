"""Operators for preparing training text, each as a job over DataFrames.

Task functions of this package travel with the job (pickled by value), so a cluster whose Python
workers do not have the package installed runs them as well.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
