"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  Its
modules travel to the Python workers by value, so executors need no installed
copy of the package.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
