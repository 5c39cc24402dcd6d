"""Data jobs behind open-domain question answering, as Spark DataFrame plans.

Every public function takes DataFrames and returns a DataFrame.  Nothing here
trains or runs a neural model; vectors come in as columns or from a pluggable
batch encoder.
"""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their code, so a cluster needs no
# copy of this package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
