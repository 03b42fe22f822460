"""Quality checks for supervised fine-tuning data as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Ship the small UDF bodies with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
