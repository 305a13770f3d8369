"""docsignal: signals, cleaning, selection and judging of labelled text corpora on Spark."""

import sys

from pyspark import cloudpickle

# Functions handed to mapInArrow & co. travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
