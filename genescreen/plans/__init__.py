"""Workloads over several operators, adapters from the given tables, and the registered queries."""
