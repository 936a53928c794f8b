"""Operators of a training-data pipeline, each a Spark job of its own.

Functions that run inside tasks are shipped with the job (pickled by value),
so executors need numpy/pandas/pyarrow but not this package.  Modules of the
subpackage therefore import names from each other, not modules: a module object
would travel as a name to import.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
