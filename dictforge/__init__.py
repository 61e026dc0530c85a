"""Dictionary tables to instruction records, as Spark DataFrame and Structured Streaming jobs."""

import sys

from pyspark import cloudpickle

from dictforge.config import Config

# Ship the few Python helpers with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Config"]
