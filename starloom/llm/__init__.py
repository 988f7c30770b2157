"""Operators of a training-data pipeline; each module holds one operator.

Documents are tables with ``doc_id`` and ``text``. Operators read those columns
only and return the identifier with columns of their own, so further input
columns, whatever their names, never clash with a result.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Tasks carry their code with them: executors need not have this package installed.
register_pickle_by_value(sys.modules[__name__])
