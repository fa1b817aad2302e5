"""Operators of a training-data pipeline: scoring, filtering, matching, mixing and counting texts.

Every operator takes DataFrames, keeps its large work in Spark's scans, shuffles and tasks, and
says in its docstring what nulls, empty texts, ties and repeated rows give.  Nothing else in the
library imports this subpackage.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# The helpers travel with the tasks that run them, so that executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
