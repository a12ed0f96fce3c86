"""lakemill: analytics operators for keyed, dated, nested documents on Spark."""
