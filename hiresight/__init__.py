"""hiresight: job-posting analytics as Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` (or Column -> Column)
function built from Spark SQL expressions, so Catalyst can prune, push down
and fuse them; nothing is collected to the driver on the data path.
"""

__version__ = "0.1.0"
