"""Operators for large-scale training-data pipelines.

Each module holds one operator with its own general interface;
:mod:`ratekit.llm.queries` derives the registered ``opN_<name>`` queries.
Nothing else in the library imports this subpackage.

Functions that run in tasks are pickled by value, so executors need no copy of
the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
