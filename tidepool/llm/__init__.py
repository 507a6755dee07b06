"""Operators for preparing training corpora; nothing else in the library imports them.

The functions that run in Python workers travel by value, so executors need numpy, pandas,
pyarrow and the tokenizer library but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
