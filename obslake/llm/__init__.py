"""Training-data operators: near-duplicates, mixing, quality, URL lists, passages, pieces,
toxicity, vector search, packing and secrets. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# what runs in Python workers is shipped with the task, so executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
