"""Operators for preparing language-model training data.

Nothing outside this package imports it. Each module holds one operator; ``queries``
registers one thin query per operator.
"""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
