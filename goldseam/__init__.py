"""goldseam: medallion-lakehouse analytics for transaction data, as Spark DataFrame jobs."""

__version__ = "0.1.0"
