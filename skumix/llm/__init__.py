"""Operators of a large-scale training-data pipeline.

One module per operator; ``queries`` registers them.  Nothing outside this
subpackage imports it (only ``__spark_entry__`` adds its queries when it
can be imported)."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so that executors need no copy of
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
