"""Training-data operators: mixing, packing, deduplication, scoring, screening.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it. Its
functions are shipped to Python workers by value, so executors need not have
the library installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
