"""issueloom: news and event issue analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

# Helpers of the Arrow functions travel with the job, so that executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
