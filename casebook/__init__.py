"""casebook — clinical treatment-journal analytics as lazy Spark DataFrame plans.

Every public function takes and returns a DataFrame (compose with ``df.transform``).
No Python UDF sits in the hot path: rules are Column expressions, per-patient work is
``groupBy`` aggregation, ordering-sensitive steps are windows with a content-hash tie-break.
"""

import sys

from pyspark import cloudpickle

from casebook.session import get_session, checkpoint_dir

# Functions of this package travel to Python workers by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_session", "checkpoint_dir"]
