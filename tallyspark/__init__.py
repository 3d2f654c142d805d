"""Donor and transaction analytics as Spark jobs.

Every operator is a function from DataFrame to DataFrame. Nothing reads a
clock: ``as_of``, ``cutoff`` and ``link_mode`` are always arguments.
"""

import os

# Spark's tasks and fits that run side by side fill the cores; linear algebra with threads of its own inside them
# waits for cores that others hold. Only the first import of numpy reads this.
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")
