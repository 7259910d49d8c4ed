"""ledgerflow: DataFrame operators and jobs for register and waste-tracking data on Spark.

Every operator is a ``DataFrame -> DataFrame`` function (usable with ``df.transform``)
without an action inside, except the checks (``operators.checks``) and the sinks.
"""

__version__ = "0.1.0"
