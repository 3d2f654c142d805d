"""Small array helpers used inside tasks.

They travel with the functions that use them, so the executors need numpy but
not this package.
"""

import sys

import numpy as np
from pyspark import cloudpickle


def matrix(series):
    """A column of arrays as one matrix."""
    return np.array(series.tolist(), dtype=float)


def distances(x, points, norms):
    """Euclidean distance of each row of ``x`` to each point; ``norms`` are the points' squares."""
    d2 = (x * x).sum(axis=1)[:, None] + norms - 2 * x @ points.T
    return np.sqrt(np.maximum(d2, 0))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
