"""Operators of a training-data pipeline; nothing else in the library imports this package.

Tasks run functions of these modules.  They, and what they use of the library, are pickled by
value, so that executors need not have the package installed.
"""

from pyspark import cloudpickle

import sortpub

cloudpickle.register_pickle_by_value(sortpub)
