"""Labelled text corpora on Spark: load, clean, encode, split, batch, train, score."""

from pyspark import cloudpickle

import corpusloom as _package

# Ship task-side functions by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(_package)

__version__ = "0.1.0"
