"""Schema-on-read ingestion with PySpark: read, clean, route and land records."""

import sys

from pyspark import cloudpickle

# The small helpers that run inside tasks travel with the plan, so executors need
# nothing but PySpark and pyarrow installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
