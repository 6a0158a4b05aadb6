"""ledgerline: marketplace change-data pipeline and analytics on Spark."""

__version__ = "0.1.0"
