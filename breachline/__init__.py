"""Service-request SLA analytics as table-in / table-out Spark operators."""
