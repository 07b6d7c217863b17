"""Operators for training-data pipelines over `documents`, `pages`, `benchmark` and `conversations`.

Nothing else in the library imports this subpackage. Functions that run in tasks are shipped with
the job, so executors need no copy of it."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
