"""Ledger analytics on Spark: cleaning, exchange-rate enrichment, star schema and customer segments."""
