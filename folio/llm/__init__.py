"""Operators of a training-data pipeline, one module each.

Nothing outside this package imports it. Functions that run in Python workers
are shipped by value, so executors do not need this repository on their path.
"""

from pyspark import cloudpickle

import folio.llm as _self

cloudpickle.register_pickle_by_value(_self)
