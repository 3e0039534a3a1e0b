"""Web-crawl analytics as Spark DataFrame and Column functions.

``functions``  Column -> Column expressions (URLs, IPs, HTML, script sources)
``operators``  DataFrame -> DataFrame steps (joins, counts, profiles, manifests)
``sources``    the ``warc`` data source and the flat-file readers and writers
``plans``      whole jobs put together from the above
``streaming``  manifest-driven incremental publishing and its ledger
``catalog``    the registered queries, each with its SQL counterpart
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so that executors
# need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
