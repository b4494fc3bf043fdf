"""Training-data operators: filtering, near-duplicates, extraction, packing and archives.

Nothing outside this package imports it. Its functions travel to the executors
by value, so a cluster needs the public Python libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
