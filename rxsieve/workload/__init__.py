"""Sample workload: stand-in inputs over the given tables, one query per operator, and SQL to check them."""
