"""Account and transaction risk analytics as Spark jobs."""
