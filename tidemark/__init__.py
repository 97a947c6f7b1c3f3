"""Point-in-time market, filings, supply-chain and climate analytics as Spark DataFrame jobs."""

__version__ = "0.1.0"
