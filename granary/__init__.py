"""granary: a grain-safe medallion library (bronze, silver, gold) for retail data on Spark."""
