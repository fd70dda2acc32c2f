"""Operators of a training-data pipeline over documents, pages and embeddings.

Each module holds one operator with its own general interface; ``queries``
derives the registered result tables from them and ``oracle`` holds their
DuckDB SQL. Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Python workers need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
