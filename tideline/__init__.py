"""Event and table analytics written as PySpark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Ship the few per-group helpers with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
