"""Operators for large-scale training-data pipelines.

Ten operators over a table of documents (``doc_id``, ``text`` and any further
columns), one module each, and their queries (``queries.py``) with DuckDB SQL
where SQL can express them (``oracle.py``). Nothing outside this package, its
tests and ``corpus_pipeline.py`` imports it.

Functions that run inside Python workers are shipped by value, so executors
need no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
