"""Operators for preparing large text corpora.

The functions that run inside tasks are shipped by value, so executors need numpy, pyarrow
and the public libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
