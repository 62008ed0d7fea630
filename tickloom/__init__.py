"""Market-tick and price-bar analytics as composable Spark DataFrame operators."""
