"""Billing documents in, checked ledger tables out: a quality engine made of Spark DataFrame steps."""
