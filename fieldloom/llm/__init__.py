"""Training-data operators over text, vectors and conversations.

Nothing else in the library imports this subpackage.  Functions that run on executors are shipped by
value, so that workers need no copy of the repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
