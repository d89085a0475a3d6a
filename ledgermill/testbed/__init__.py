"""Ledger tables derived from the driver's tables, the registered queries on them, and their SQL twins."""
