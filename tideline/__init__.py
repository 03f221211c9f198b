"""tideline: market-data and event analytics as Spark DataFrame operators."""
