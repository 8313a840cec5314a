"""Snapshot analytics for lending data on PySpark.

Layers:

* ``functions``  Column -> Column expressions (cleaning, loan arithmetic, dates)
* ``operators``  DataFrame -> DataFrame building blocks
* ``sources``    typed scans, partitioned stores, the model registry
* ``plans``      whole jobs: medallion, training, scoring, monitoring
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run inside tasks travel with their code, so that workers need no
# copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
