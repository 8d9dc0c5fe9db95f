"""Panel-sales estimation as composable Spark DataFrame operators."""
