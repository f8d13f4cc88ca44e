"""Operators of a training-data pipeline (dedup, counts, packing, language, ...).

Nothing else in the library imports this package.  Its Python functions run in
Spark's Arrow workers; they travel with the task (pickled by value), so an
executor needs the public libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
