"""Operators for training-data pipelines: extraction, filters, sampling, packing, search.

Functions that run inside tasks are shipped with the tasks, so executors need no copy of the
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
