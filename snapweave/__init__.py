"""snapweave: weekly snapshot analytics on Spark.

Dirty tabular extracts in, one clean row per business key and week out, then
marts and dashboard queries on top. Every step is a DataFrame or SQL
transformation; the driver only holds contracts and small reports. The functions
that parse files travel to the executors by value, so they need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

from snapweave.session import get_session, shared_dir  # noqa: E402

__all__ = ["get_session", "shared_dir"]
