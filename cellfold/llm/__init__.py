"""Training-data operators: near-duplicates, mixing, secrets, fingerprints,
decontamination, licences, sharding, quality, chat formatting, URL rules.

Nothing else in the package imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to Python tasks by value, so executors
# need no installed copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
