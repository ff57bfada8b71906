"""Operators of a training-data pipeline: quality bands, decontamination, near
and substring de-duplication, source mixing, URL reputation, license and
language labels, personal data, archive fixity, byte-level BPE, dataset manifests,
hard negatives.

One module per operator; ``queries`` registers the ``opN_*`` queries and
``oracle`` the SQL of those that SQL can express.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: the workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
