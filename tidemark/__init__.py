"""Controlled data migration and financial data quality on Spark."""
