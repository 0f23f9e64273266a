"""Training-data operators: dedup, decontamination, filters, scans and mixing.

Every module holds one operator with a general interface over any DataFrame;
``queries`` binds them to the driver tables. The functions that run inside
tasks are shipped by value, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
