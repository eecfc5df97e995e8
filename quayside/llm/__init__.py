"""Operators of a training-data pipeline, each written as a Spark job.

Nothing outside this package imports it; ``queries.QUERIES`` and
``queries.ORACLES`` are added to the driver contract only if the package is there.

The Python functions that run inside tasks are pickled by value, so executors
need only the public libraries, not an installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
