"""Sitemaps and fetched web pages in, a clean deduplicated article dataset out, as Spark jobs."""

import sys

from pyspark import cloudpickle

# The few Python helpers travel with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
