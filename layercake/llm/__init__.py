"""Operators of a training-data pipeline (mixing, quality, dedup, WARC, LM scoring, ...).

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds its
queries when it is present.  One module per operator; ``queries.py`` registers them.
"""

import sys

from pyspark import cloudpickle

# tasks carry this subpackage's functions themselves: executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
