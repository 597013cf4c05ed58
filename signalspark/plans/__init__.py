"""Composite jobs (produce, ingest, echo, report) and the registered test queries."""
