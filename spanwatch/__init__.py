"""spanwatch: structural-sensor monitoring as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few Python functions that run inside tasks travel with the tasks, so executors need
# numpy, pandas and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
