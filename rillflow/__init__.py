"""rillflow: DataFrame operators for logs, relational tables, graphs, streams and embeddings."""

import sys

from pyspark import cloudpickle

# The few Python functions travel with their job, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
