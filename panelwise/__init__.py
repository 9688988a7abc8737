"""Cross-sectional return-signal panels on Spark: load, align, prepare, predict, sort, judge.

Every public function takes and returns Spark DataFrames. Long tables are the canonical form;
wide tables exist only at sinks.
"""

import sys

from pyspark import cloudpickle

# The small functions that run inside tasks travel with the job; executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
