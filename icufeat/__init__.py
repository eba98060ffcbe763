"""Patient-level feature tables and model evaluation from ICU event data, on Spark."""
