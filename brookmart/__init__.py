"""brookmart: a retail data warehouse (logs, orders, dimensions, reports) on Spark."""
