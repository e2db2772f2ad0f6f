"""Training-data operators. Nothing else in the library imports this subpackage."""
import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to executors inside the job, so no executor needs it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
