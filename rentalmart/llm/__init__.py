"""Operators for preparing training text, each as an ordinary Spark job.

The modules are shipped to executors by value, so a job needs nothing installed there but
the Python libraries it uses (numpy, tokenizers, ...).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
