"""pricelens: price-panel analytics written as Spark DataFrame jobs.

Every public function maps DataFrame(s) to a DataFrame; nothing is
collected to the driver except bounded scalars (a handful of dates, the
size of a top-k key set, per-partition row counts).
"""

__version__ = "0.1.0"
