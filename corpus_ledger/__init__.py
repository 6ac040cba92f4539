"""Corpus Ledger: Spark jobs that keep a full-text paper corpus complete and consistent."""

import sys

from pyspark import cloudpickle

# Python tasks carry their code with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
