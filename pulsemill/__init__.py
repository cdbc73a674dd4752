"""Pulsemill: engagement analytics on Spark.

Change feeds -> after-images -> enrichment (stream or batch) -> warehouse,
key-value projection and batched delivery -> analytic queries.  Every public
function takes and returns DataFrames; nothing is evaluated until a sink runs.
"""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: the few Python functions that run in
# tasks (state machine, delivery) travel by value with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
