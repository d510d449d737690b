"""Operations of a pipeline that prepares training data; nothing else in the library imports this.

Functions that Spark's Python workers run are sent with the job, so that the executors don't
need this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
