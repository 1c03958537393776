"""Receivables, payables and cash-flow analytics as Spark DataFrame operators."""
