"""tidemill: demand-feature, BOM and event-log analytics as Spark DataFrame jobs."""

__version__ = "0.1.0"
