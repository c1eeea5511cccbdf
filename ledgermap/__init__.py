"""Ledger migration on Spark: translation tables, import datasets and reconciliation reports."""

__version__ = "0.1.0"
