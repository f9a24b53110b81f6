"""End-to-end plans, and the queries that run the operators over the benchmark tables."""
