"""partnerwatch: peer-group anomaly analytics for receivables ledgers on Spark.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` and creates
no session; nothing that grows with the data is collected to the driver.
"""

from partnerwatch.config import DEFAULTS, Alerting, Scoring, Settings, Signals, Tables  # noqa: F401

__version__ = "0.1.0"
