"""Stand-in inputs for the registered queries and tests: dirty weekly extracts made from the given tables.

Not part of the library, which never imports it. It gives rows and files in the shape the jobs expect and
does none of the jobs' work.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
