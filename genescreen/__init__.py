"""PySpark library for gene-loss screening tables."""
