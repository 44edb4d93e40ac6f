"""ticketgrain - support-ticket text analytics on PySpark."""

import sys

from pyspark import cloudpickle

# Executors need not have the package installed: its few Python functions travel
# with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
