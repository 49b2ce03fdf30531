"""loomgraph: a PySpark-native engine that weaves catalogue records into a knowledge graph."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to executors carry their code along, so the package needs no installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
